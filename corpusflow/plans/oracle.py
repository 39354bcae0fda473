"""Independent DuckDB SQL for every registered query (same column names and types).

Written against the pre-registered views of the driver tables; the SQL recomputes each
binding from scratch rather than reusing the Spark plans.
"""

from __future__ import annotations

# Fixed values, typed out here on their own: letters, numbers and underscore; white space as
# Python's str.isspace sees it.
WORD = r"\p{L}\p{N}_"
WS = r"\t\n\x0b\x0c\r\x1c-\x1f\x85\p{Z}"

# --- SQL expression builders ----------------------------------------------------------------


def slug(x: str) -> str:
    a = f"regexp_replace({x}, '[^{WORD}{WS}-]', '', 'g')"
    b = f"regexp_replace({a}, '^[{WS}]+|[{WS}]+$', '', 'g')"
    return f"regexp_replace(lower({b}), '[-{WS}]+', '-', 'g')"


def slug_admin(x: str) -> str:
    a = f"regexp_replace(lower({x}), '[^{WORD}{WS}-]', '', 'g')"
    b = f"regexp_replace({a}, '[-{WS}]+', '-', 'g')"
    return f"regexp_replace({b}, '^-+|-+$', '', 'g')"


def fold(x: str) -> str:
    return slug(f"regexp_replace({x}, '[^\\x00-\\x7F]', '', 'g')")


def ellip(x: str, n: int = 50) -> str:
    return f"(CASE WHEN length({x}) > {n} THEN substr({x}, 1, {n - 3}) || '...' ELSE {x} END)"


def zfill(x: str) -> str:
    return (
        f"(CASE WHEN length({x}) >= 3 THEN {x} "
        f"WHEN regexp_matches({x}, '^[+-]') THEN left({x}, 1) || lpad(substr({x}, 2), 2, '0') "
        f"ELSE lpad({x}, 3, '0') END)"
    )


def strip_us(x: str) -> str:
    return f"regexp_replace({x}, '^_+|_+$', '', 'g')"


URL_RE = "^(?:([A-Za-z][A-Za-z0-9+.-]*):)?(?://([^/?#]*))?([^?#]*)"


def authority(x: str) -> str:
    return f"regexp_extract({x}, '{URL_RE}', 2)"


def upath(x: str) -> str:
    return f"regexp_replace(regexp_extract({x}, '{URL_RE}', 3), ';[^/]*$', '')"


def page_slug_sql(x: str) -> str:
    p = upath(x)
    seg = f"list_filter(string_split({p}, '/'), lambda s: contains(s, '.php'))[1]"
    return f"(CASE WHEN {seg} IS NOT NULL THEN {slug(f'split_part({seg}, {chr(39)}.php{chr(39)}, 1)')} ELSE {slug(strip_us(f'replace({p}, {chr(39)}/{chr(39)}, {chr(39)}_{chr(39)})'))} END)"


def page_slug_admin_sql(x: str) -> str:
    p = upath(x)
    seg = f"list_filter(string_split({p}, '/'), lambda s: contains(s, '.php'))[1]"
    return f"(CASE WHEN {seg} IS NOT NULL THEN {strip_us(f'replace(split_part({seg}, {chr(39)}.php{chr(39)}, 1), {chr(39)}/{chr(39)}, {chr(39)}_{chr(39)})')} ELSE {strip_us(f'replace({p}, {chr(39)}/{chr(39)}, {chr(39)}_{chr(39)})')} END)"


def quote(x: str) -> str:
    return f"replace(url_encode({x}), '%2F', '/')"


def unescape(x: str) -> str:
    for ent, ch in [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&apos;", "''"), ("&nbsp;", "\u00a0"), ("&copy;", "©"), ("&middot;", "·"), ("&amp;", "&")]:
        x = f"replace({x}, '{ent}', '{ch}')"
    return x


def strip_ws(x: str) -> str:
    return f"regexp_replace({x}, '^[{WS}]+|[{WS}]+$', '', 'g')"


def combined(t: str, a: str) -> str:
    return ellip(strip_us(f"({t}) || '_' || ({a})"))


def apath(base: str, page: str, bid: str, name: str) -> str:
    return f"'{base}' || '/' || {page} || '/' || {zfill(bid)} || '/' || {name}"


ORACLE: dict[str, str] = {}

# --- flagship ---------------------------------------------------------------------------------

ORACLE["corpus_readiness"] = """
SELECT d.lang,
       count(*)::BIGINT AS documents,
       sum(CASE WHEN d.n_chars > 500 THEN ceil(d.n_chars / 500) ELSE 1 END)::BIGINT AS chunks,
       count(DISTINCT sha256(d.text))::BIGINT AS distinct_digests,
       count(l.quality)::BIGINT AS labelled,
       count(*) FILTER (WHERE (CASE WHEN l.quality = 1 THEN 'completed' END) IS DISTINCT FROM 'completed')::BIGINT AS pending
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
GROUP BY d.lang
"""

# --- P over documents ---------------------------------------------------------------------------

ORACLE["slugify"] = f"SELECT doc_id, {slug('text')} AS slug FROM documents"
ORACLE["slugify_admin"] = f"SELECT doc_id, {slug_admin('text')} AS slug FROM documents"
ORACLE["ellipsize"] = f"SELECT doc_id, {ellip('text')} AS short_text FROM documents"
ORACLE["ascii_fold"] = f"SELECT doc_id, {fold('text')} AS slug FROM documents"
ORACLE["url_quote"] = f"SELECT doc_id, {quote('text')} AS quoted FROM documents"
ORACLE["zfill_id"] = f"SELECT p_partkey, {zfill('CAST(p_partkey AS VARCHAR)')} AS zid, {zfill('CAST(p_partkey - 50 AS VARCHAR)')} AS zid_signed FROM part"

_BOOKS = f"""
books AS (
  SELECT doc_id, {slug('lang')} AS page_slug, 'D' || CAST(doc_id AS VARCHAR) AS id,
         'D' || CAST(doc_id AS VARCHAR) || '_' || {combined(slug('text'), slug('source'))} || '.pdf' AS fname
  FROM documents
),
paths AS (
  SELECT doc_id, page_slug, id, fname,
         {apath('raw_pdf', 'page_slug', 'id', 'fname')} AS local_pdf_path,
         {apath('processed_docs', 'page_slug', 'id', "replace(fname, '.pdf', '.md')")} AS local_md_path,
         {apath('processed_docs', 'page_slug', 'id', "replace(fname, '.pdf', '.docx')")} AS local_docx_path
  FROM books
)"""

ORACLE["book_paths"] = f"WITH {_BOOKS} SELECT doc_id, local_pdf_path, local_md_path, local_docx_path FROM paths"

ORACLE["scraped_paths"] = f"""
WITH s AS (
  SELECT doc_id, {slug('lang')} AS page_slug, 'D' || CAST(doc_id AS VARCHAR) AS id,
         {slug('text')} AS title_english_slug, {slug('source')} AS author_english_slug
  FROM documents
), f AS (
  SELECT *, id || '_' || concat_ws('_', nullif({ellip('title_english_slug')}, ''), nullif({ellip('author_english_slug')}, '')) || '.pdf' AS fname FROM s
)
SELECT doc_id, title_english_slug, author_english_slug,
       {apath('raw_pdf', 'page_slug', 'id', 'fname')} AS local_pdf_path,
       {apath('processed_docs', 'page_slug', 'id', "replace(fname, '.pdf', '.md')")} AS local_md_path,
       {apath('processed_docs', 'page_slug', 'id', "replace(fname, '.pdf', '.docx')")} AS local_docx_path
FROM f
"""

ORACLE["swap_suffix"] = f"WITH {_BOOKS} SELECT doc_id, replace(fname, '.pdf', '.md') AS md_name, replace(fname, '.pdf', '.docx') AS docx_name FROM paths"

ORACLE["artifact_layout"] = f"""WITH {_BOOKS}
SELECT doc_id, local_pdf_path,
       {apath('/sdcard/raw_pdf', 'page_slug', 'id', 'fname')} AS sd_pdf_path,
       {apath('/sdcard/processed_docs', 'page_slug', 'id', "replace(fname, '.pdf', '.md')")} AS sd_md_path,
       {apath('/sdcard/processed_docs', 'page_slug', 'id', "replace(fname, '.pdf', '.docx')")} AS sd_docx_path
FROM paths"""

ORACLE["basename"] = f"""WITH {_BOOKS}
SELECT doc_id, regexp_extract(local_pdf_path, '([^/]+)$', 1) AS file_name,
       regexp_replace(regexp_extract(local_pdf_path, '([^/]+)$', 1), '^(.*?[^.].*)\\.[^.]*$', '\\1') AS file_stem
FROM paths"""

# --- P over pages ---------------------------------------------------------------------------------

ORACLE["page_slug"] = f"SELECT page_id, {page_slug_sql('url')} AS page_slug FROM pages"
ORACLE["page_slug_admin"] = f"SELECT page_id, {page_slug_admin_sql('url')} AS page_slug FROM pages"
ORACLE["state_name"] = f"SELECT page_id, 'processing_state_' || {page_slug_sql('url')} || '.json' AS state_file FROM pages"
ORACLE["url_authority"] = f"SELECT page_id, {authority('url')} AS authority, {upath('url')} AS path FROM pages"
ORACLE["item_identifier"] = f"SELECT page_id, nullif(regexp_extract({upath('url')}, '/[a-z]{{2}}/([^/]+)', 1), '') AS item_id FROM pages"

_NAV = """
nav AS (
  SELECT page_id, url,
         regexp_extract_all(html, '<li><a href="([^"]*)">([^<]*)</a></li>', 1) AS hrefs,
         regexp_extract_all(html, '<li><a href="([^"]*)">([^<]*)</a></li>', 2) AS texts
  FROM pages
),
items AS (
  SELECT page_id, url, i - 1 AS item_pos, hrefs[i] AS raw_href, texts[i] AS raw_text
  FROM nav, generate_series(1, len(hrefs)) AS g(i)
)"""

_HREF = strip_ws(unescape("raw_href"))
_TXT = strip_ws(unescape("raw_text"))

ORACLE["url_join"] = f"""WITH {_NAV}
SELECT page_id, item_pos::BIGINT AS item_pos, {_HREF} AS href,
       regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)', 1) || {_HREF} AS abs_url
FROM items"""

ORACLE["catalogue_items"] = f"WITH {_NAV} SELECT page_id, item_pos::BIGINT AS item_pos, {_TXT} AS title_original, {_HREF} AS pdf_href FROM items"

ORACLE["catalogue_fields"] = f"""
SELECT page_id,
       {strip_ws(unescape("regexp_extract(html, '(?s)<title(?:\\s[^>]*)?>([^<]*)</title>', 1)"))} AS title,
       {strip_ws(unescape("regexp_extract(html, '(?s)<h1(?:\\s[^>]*)?>([^<]*)</h1>', 1)"))} AS h1,
       regexp_extract(html, '<html[^>]*\\slang="([^"]*)"', 1) AS lang
FROM pages"""

ORACLE["catalogue_ids"] = """
SELECT page_id, coalesce(nullif(regexp_extract(url, 'book_id=(\\d+[A-Z]?)', 1), ''),
                         nullif(regexp_extract(url, '/(\\d{3,}[A-Z]?)/index\\.pdf', 1), ''),
                         nullif(regexp_extract(url, '/[a-z]{2}/(\\d+[A-Z]?)', 1), ''), '') AS id
FROM pages"""

_ITEMS_ID = f"""{_NAV},
withid AS (
  SELECT page_id, item_pos, {_TXT} AS title_original, {_HREF} AS pdf_href,
         regexp_extract({_HREF}, '^/([^,/?#]+)$', 1) AS id
  FROM items
),
flag AS (
  SELECT *, (coalesce(title_original, '') <> '' AND coalesce(pdf_href, '') <> '' AND coalesce(id, '') <> '') AS complete FROM withid
)"""

ORACLE["complete_items"] = f"WITH {_ITEMS_ID} SELECT page_id, item_pos::BIGINT AS item_pos, id, complete FROM flag"
ORACLE["catalogue_counts"] = f"""WITH {_ITEMS_ID}
SELECT page_id, count(*)::BIGINT AS n_items, count(*) FILTER (WHERE complete)::BIGINT AS n_complete,
       count(*) FILTER (WHERE NOT complete)::BIGINT AS n_rejected
FROM flag GROUP BY page_id"""

_CFG = f"""{_NAV},
cfg AS (
  SELECT p.page_id,
         coalesce(nullif({strip_ws(unescape("regexp_extract(p.html, '(?s)<h1(?:\\s[^>]*)?>([^<]*)</h1>', 1)"))}, ''), 'Unknown Page') AS page_name,
         coalesce(nullif(regexp_extract(p.html, '<html[^>]*\\slang="([^"]*)"', 1), ''), 'kn-IN') AS page_language,
         nullif(regexp_extract(p.html, '<html[^>]*\\slang="([^"]*)"', 1), '') AS raw_lang
  FROM pages p
),
cfg2 AS (
  SELECT *, coalesce(raw_lang, '') <> 'de' AS process_flag,
         CASE WHEN raw_lang <> 'en' THEN 3 END::INTEGER AS page_limit,
         {slug('page_name')} AS page_slug
  FROM cfg
)"""

ORACLE["config_flatten"] = f"""WITH {_CFG}
SELECT c.page_id, i.item_pos::BIGINT AS book_pos, c.page_name, c.page_language, coalesce(c.page_limit, 0)::INTEGER AS page_limit, c.page_slug,
       substr(i.raw_href, 2) AS id, {unescape('i.raw_text')} AS title_original, '' AS author_original, i.raw_href AS pdf_url
FROM cfg2 c JOIN items i ON c.page_id = i.page_id
WHERE c.process_flag"""

ORACLE["enabled_pages"] = f"WITH {_CFG} SELECT page_id, page_name, page_language, page_slug FROM cfg2 WHERE process_flag"

# --- listings over lineitem ------------------------------------------------------------------------

_LISTING = """
lst AS (
  SELECT l_orderkey AS item_id,
         (row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_shipdate) - 1)::BIGINT AS pos,
         CAST(l_partkey AS VARCHAR) || CASE WHEN l_returnflag = 'R' THEN '_text.pdf'
                                             WHEN l_returnflag = 'A' AND l_linestatus = 'F' THEN '.PDF'
                                             WHEN l_returnflag = 'A' THEN '.pdf' ELSE '.txt' END AS name,
         CASE WHEN l_discount = 0 THEN NULL
              WHEN l_tax = 0.08 AND l_linestatus = 'O' THEN 'abc'
              ELSE CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) END AS size
  FROM lineitem
)"""

ORACLE["file_listing"] = f"WITH {_LISTING} SELECT item_id, pos, name, size FROM lst"
ORACLE["pdf_files"] = f"WITH {_LISTING} SELECT item_id, pos, name FROM lst WHERE ends_with(lower(name), '.pdf')"

_BEST = f"""{_LISTING},
pdf AS (
  SELECT item_id, pos, name, contains(lower(name), '_text.pdf') AS is_text,
         CASE WHEN size IS NULL THEN 0 ELSE TRY_CAST(trim(replace(size, '_', '')) AS BIGINT) END AS sz,
         size IS NOT NULL AND TRY_CAST(trim(replace(size, '_', '')) AS BIGINT) IS NULL AS bad
  FROM lst WHERE ends_with(lower(name), '.pdf')
),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY is_text, coalesce(sz, 0) DESC, pos) AS rk FROM pdf
),
agg AS (
  SELECT item_id, count(*)::BIGINT AS n_pdf,
         count(*) FILTER (WHERE NOT is_text) AS n_main,
         count(*) FILTER (WHERE NOT is_text AND bad) AS bad_main,
         count(*) FILTER (WHERE is_text AND bad) AS bad_text,
         max(CASE WHEN rk = 1 THEN name END) AS best
  FROM ranked GROUP BY item_id
),
best AS (
  SELECT item_id, n_pdf,
         CASE WHEN (CASE WHEN n_main > 0 THEN bad_main > 0 ELSE bad_text > 0 END) THEN NULL ELSE best END AS best_name,
         CASE WHEN n_main > 0 THEN bad_main > 0 ELSE bad_text > 0 END AS size_error
  FROM agg
)"""

ORACLE["best_file"] = f"WITH {_BEST} SELECT item_id, n_pdf, best_name, size_error FROM best"
ORACLE["first_entry"] = f"""WITH {_LISTING}
SELECT item_id, arg_min(name, pos) FILTER (WHERE ends_with(name, '.txt')) AS first_txt FROM lst GROUP BY item_id"""

ORACLE["resolved_urls"] = f"""WITH {_BEST},
cat AS (
  SELECT o_orderkey, 'https://archive.example.org' || CASE WHEN o_orderstatus = 'P' THEN '/stream/' ELSE '/details/' END || CAST(o_orderkey AS VARCHAR) AS url
  FROM orders
),
cat2 AS (SELECT *, nullif(regexp_extract({upath('url')}, '/details/([^/]+)', 1), '') AS ident FROM cat)
SELECT c.o_orderkey,
       CASE WHEN c.ident IS NULL THEN c.url
            WHEN coalesce(b.size_error, false) THEN 'https://archive.example.org/download/' || c.ident || '/' || c.ident || '.pdf'
            WHEN b.best_name IS NOT NULL THEN 'https://archive.example.org/download/' || c.ident || '/' || {quote('b.best_name')}
            ELSE c.url END AS resolved_url
FROM cat2 c LEFT JOIN best b ON c.ident = CAST(b.item_id AS VARCHAR)"""

# --- page metadata over lineitem ----------------------------------------------------------------------

_BLOCKS = """
blk AS (
  SELECT l_orderkey AS doc_id, (l_suppkey % 3)::INTEGER AS part, 'page_' || CAST(l_linenumber AS VARCHAR) || '.json' AS file_name,
         l_linenumber AS page_num,
         (row_number() OVER (PARTITION BY l_orderkey, l_suppkey % 3, l_linenumber ORDER BY l_partkey, l_suppkey, l_quantity, l_shipdate) - 1)::BIGINT AS block_pos,
         'b' || CAST(l_partkey AS VARCHAR) || '_' || CAST(l_suppkey AS VARCHAR) AS block_id,
         CASE WHEN l_returnflag <> 'N' THEN l_quantity / 50 END AS confidence
  FROM lineitem
),
b AS (SELECT * FROM blk WHERE confidence IS NOT NULL)"""

ORACLE["block_explode"] = f"WITH {_BLOCKS} SELECT doc_id, part, file_name, page_num, block_pos, block_id, confidence FROM b"
ORACLE["low_confidence_blocks"] = f"WITH {_BLOCKS} SELECT doc_id, part, file_name, page_num, block_pos, block_id, confidence FROM b WHERE confidence < 0.7"
ORACLE["confidence_metrics"] = f"""WITH {_BLOCKS},
m AS (
  SELECT doc_id, avg(confidence) AS a, count(*) FILTER (WHERE confidence < 0.7) AS n,
         array_to_string(list_sort(list_distinct(list(page_num) FILTER (WHERE confidence < 0.7))), ',') AS pages
  FROM b GROUP BY doc_id
)
SELECT o.o_orderkey AS doc_id, round(m.a, 6) AS avg_page_confidence,
       coalesce(m.n, 0)::BIGINT AS low_confidence_blocks_count, coalesce(m.pages, '') AS pages_with_low_confidence_blocks
FROM orders o LEFT JOIN m ON o.o_orderkey = m.doc_id"""
ORACLE["distinct_low_pages"] = f"WITH {_BLOCKS} SELECT DISTINCT doc_id, page_num FROM b WHERE confidence < 0.7"

_MPAGES = """
mp AS (
  SELECT l_orderkey AS doc_id, (l_suppkey % 3)::INTEGER AS part, 'page_' || CAST(l_linenumber AS VARCHAR) || '.json' AS file_name,
         l_linenumber AS page_num, count(*)::BIGINT AS n_blocks
  FROM lineitem GROUP BY l_orderkey, l_suppkey % 3, l_linenumber
)"""

ORACLE["merge_metadata"] = f"WITH {_MPAGES} SELECT doc_id, part, file_name, page_num, n_blocks FROM mp"
ORACLE["sort_metadata"] = f"""WITH {_MPAGES}
SELECT doc_id, part, file_name, row_number() OVER (PARTITION BY doc_id ORDER BY file_name, part)::BIGINT AS file_rank FROM mp"""

# --- chunks over documents -------------------------------------------------------------------------------

_PLAN = """
plan AS (
  SELECT d.*, p.part,
         CASE WHEN p.part IS NULL THEN 0 ELSE (p.part - 1) * 500 END::BIGINT AS start_page,
         CASE WHEN p.part IS NULL THEN d.n_chars ELSE least(p.part * 500, d.n_chars) END::BIGINT AS end_page
  FROM documents d,
       unnest(CASE WHEN d.n_chars > 500 THEN generate_series(1, CAST(ceil(d.n_chars / 500) AS BIGINT)) ELSE [NULL::BIGINT] END) AS p(part)
)"""

ORACLE["chunk_plan"] = f"WITH {_PLAN} SELECT doc_id, coalesce(part, 0)::BIGINT AS part, start_page, end_page FROM plan"
ORACLE["chunk_names"] = f"""WITH {_BOOKS}, {_PLAN.strip()},
st AS (SELECT doc_id, regexp_replace(fname, '^(.*?[^.].*)\\.[^.]*$', '\\1') AS stem FROM paths)
SELECT p.doc_id, coalesce(p.part, 0)::BIGINT AS part,
       CASE WHEN p.part IS NOT NULL THEN s.stem || '_chunks/' || s.stem || '_part_' || CAST(p.part AS VARCHAR) || '.pdf' ELSE s.stem || '.pdf' END AS chunk_pdf,
       CASE WHEN p.part IS NOT NULL THEN s.stem || '_part_' || CAST(p.part AS VARCHAR) || '.md' ELSE s.stem || '.md' END AS chunk_md
FROM plan p JOIN st s ON p.doc_id = s.doc_id"""
ORACLE["chunk_slices"] = f"WITH {_PLAN} SELECT doc_id, coalesce(part, 0)::BIGINT AS part, substr(text, CAST(start_page + 1 AS INTEGER), CAST(end_page - start_page AS INTEGER)) AS slice FROM plan"

_PRE = """
pre AS (
  SELECT doc_id, n_chars,
         CASE WHEN doc_id % 4 = 3 THEN 'PDF file not found.'
              WHEN doc_id % 17 = 0 AND doc_id % 2 = 0 THEN 'Corrupted PDF file: EOF marker not found'
              WHEN doc_id % 17 = 0 THEN 'Error reading PDF file: EOF marker not found' END AS precheck_error
  FROM documents
)"""

ORACLE["precheck_triage"] = f"WITH {_PRE} SELECT doc_id, precheck_error, CASE WHEN precheck_error IS NULL THEN n_chars ELSE 0 END::BIGINT AS page_count FROM pre"
ORACLE["precheck_placeholder"] = f"""WITH {_BOOKS}, {_PRE.strip()}
SELECT p.doc_id, '# OCR Failed for ' || b.fname || chr(10) || chr(10) || 'Error: ' || p.precheck_error || chr(10) ||
       'This is a placeholder Markdown file due to PDF pre-check failure.' AS placeholder
FROM pre p JOIN paths b ON p.doc_id = b.doc_id WHERE p.precheck_error IS NOT NULL"""

# --- chunk outputs over conversations ------------------------------------------------------------------------

_CO = """
co AS (
  SELECT conv_id, turn, length(text) % 13 <> 0 AS has_text,
         NOT (role = 'assistant' AND length(text) % 11 = 0) AS has_metadata
  FROM conversations
),
co2 AS (SELECT *, has_text AND has_metadata AS good FROM co),
ds AS (
  SELECT conv_id, count(*)::BIGINT AS n_chunks, count(*) FILTER (WHERE good)::BIGINT AS n_good, bool_and(good) AS success FROM co2 GROUP BY conv_id
)"""

ORACLE["chunk_outputs_join"] = f"WITH {_CO} SELECT conv_id, turn, has_text, has_metadata, good FROM co2"
ORACLE["document_success"] = f"WITH {_CO} SELECT conv_id, n_chunks, n_good, success FROM ds"
ORACLE["ordered_merge"] = f"""WITH {_CO}
SELECT c.conv_id, count(*)::BIGINT AS n_parts,
       string_agg(c.text || chr(10) || chr(10) || '---' || chr(10) || chr(10), '' ORDER BY c.turn) AS merged_text
FROM conversations c JOIN ds ON c.conv_id = ds.conv_id WHERE ds.success GROUP BY c.conv_id"""

# --- digests over documents ------------------------------------------------------------------------------------

_DIG = """
dg AS (
  SELECT doc_id, doc_id % 4 <> 3 AS present,
         CASE WHEN doc_id % 4 <> 3 THEN sha256(text) END AS sha256,
         CASE WHEN doc_id % 4 = 1 THEN NULL WHEN doc_id % 4 = 2 THEN sha256(text || 'x') ELSE sha256(text) END AS recorded
  FROM documents
),
vd AS (
  SELECT *, CASE WHEN NOT present THEN 'missing' WHEN sha256 IS NULL THEN 'refetch'
                 WHEN coalesce(recorded, '') = '' THEN 'adopted' WHEN sha256 = recorded THEN 'verified' ELSE 'refetch' END AS verdict
  FROM dg
)"""

ORACLE["file_digest"] = f"WITH {_DIG} SELECT doc_id, sha256 FROM dg"
ORACLE["checksum_verify"] = f"WITH {_DIG} SELECT doc_id, verdict, CASE WHEN verdict IN ('verified', 'adopted') THEN sha256 ELSE recorded END AS pdf_sha256_hash FROM vd"

# --- state over orders ---------------------------------------------------------------------------------------------

_STATE = f"""
st AS (
  SELECT {slug('o_orderpriority')} AS page_slug, CAST(o_orderkey AS VARCHAR) AS id, o_orderkey, o_orderstatus,
         'Order ' || CAST(o_orderkey AS VARCHAR) AS title_original,
         'https://archive.example.org/details/' || CAST(o_orderkey AS VARCHAR) AS pdf_url,
         'old/' || CAST(o_orderkey AS VARCHAR) || '.pdf' AS local_pdf_path,
         'old/' || CAST(o_orderkey AS VARCHAR) || '.md' AS local_md_path,
         'old/' || CAST(o_orderkey AS VARCHAR) || '.docx' AS local_docx_path,
         CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'P' THEN 'in_progress' ELSE 'failed' END AS status,
         CASE WHEN o_custkey % 2 = 0 THEN 'completed' END AS download_status,
         CASE WHEN o_custkey % 3 = 0 THEN 'completed' WHEN o_custkey % 3 = 1 THEN 'pending' END AS ocr_status,
         CASE WHEN o_custkey % 5 <= 1 THEN 'completed' WHEN o_custkey % 5 = 2 THEN 'pending' WHEN o_custkey % 5 = 3 THEN 'failed' END AS docx_conversion_status,
         CASE WHEN o_orderstatus = 'O' THEN 'stage error' END AS error_message
  FROM orders
)"""

_REMAINING = """concat_ws(',', CASE WHEN download_status IS DISTINCT FROM 'completed' THEN 'download' END,
                     CASE WHEN ocr_status IS DISTINCT FROM 'completed' THEN 'ocr' END,
                     CASE WHEN docx_conversion_status IS DISTINCT FROM 'completed' THEN 'docx' END)"""

ORACLE["pending_books"] = f"WITH {_STATE} SELECT page_slug, id, status FROM st WHERE status IS DISTINCT FROM 'completed'"
ORACLE["resettable"] = f"WITH {_STATE} SELECT page_slug, id, status FROM st WHERE status IN ('failed', 'in_progress')"
ORACLE["stage_todo"] = f"WITH {_STATE} SELECT page_slug, id, {_REMAINING} AS remaining FROM st"
ORACLE["reset_statuses"] = f"""WITH {_STATE}, r AS (SELECT *, status IN ('failed', 'in_progress') AS hit FROM st)
SELECT page_slug, id,
       CASE WHEN hit THEN 'pending' ELSE status END AS status,
       CASE WHEN hit THEN 'pending' ELSE download_status END AS download_status,
       CASE WHEN hit THEN 'pending' ELSE ocr_status END AS ocr_status,
       CASE WHEN hit THEN 'pending' ELSE docx_conversion_status END AS docx_conversion_status,
       CASE WHEN hit THEN NULL ELSE error_message END AS error_message
FROM r"""
ORACLE["reset_counts"] = f"WITH {_STATE} SELECT page_slug, count(*) FILTER (WHERE status IN ('failed', 'in_progress'))::BIGINT AS n_reset FROM st GROUP BY page_slug"

_LIMITED = f"""{_STATE},
lim AS (
  SELECT DISTINCT {slug('o_orderpriority')} AS page_slug,
         CASE o_orderpriority WHEN '1-URGENT' THEN 100 WHEN '3-MEDIUM' THEN 0 WHEN '4-NOT SPECIFIED' THEN 250 WHEN '5-LOW' THEN 2 END AS lim
  FROM orders
),
pend AS (
  SELECT s.*, l.lim,
         row_number() OVER (PARTITION BY s.page_slug ORDER BY {zfill('s.id')}, s.id)::BIGINT AS ordinal,
         count(*) OVER (PARTITION BY s.page_slug)::BIGINT AS n
  FROM st s LEFT JOIN lim l ON s.page_slug = l.page_slug
  WHERE s.status IS DISTINCT FROM 'completed'
),
kept AS (
  SELECT *, CASE WHEN coalesce(lim, 0) = 0 THEN n ELSE least(n, lim) END::BIGINT AS total
  FROM pend WHERE coalesce(lim, 0) = 0 OR ordinal <= lim
)"""

ORACLE["limit_per_page"] = f"WITH {_LIMITED} SELECT page_slug, id, ordinal FROM kept"
ORACLE["progress_index"] = f"WITH {_LIMITED} SELECT page_slug, id, ordinal, total FROM kept"
ORACLE["pending_counts"] = f"WITH {_LIMITED} SELECT page_slug, count(*)::BIGINT AS n_to_process FROM kept GROUP BY page_slug"
ORACLE["resume_plan"] = f"WITH {_LIMITED} SELECT page_slug, id, ordinal, total, {_REMAINING} AS remaining FROM kept"
ORACLE["sort_books"] = f"""
SELECT p_partkey, {zfill('CAST(p_partkey AS VARCHAR)')} AS zid,
       row_number() OVER (ORDER BY {zfill('CAST(p_partkey AS VARCHAR)')}, CAST(p_partkey AS VARCHAR))::BIGINT AS sort_rank
FROM part"""

ORACLE["stage_transition"] = f"""WITH {_STATE},
j AS (
  SELECT s.*, o_orderkey % 2 <> 0 AS dl_ok, o_orderkey % 3 <> 0 AS ocr_ok, o_orderkey % 5 <> 0 AS cv_ok,
         o_orderkey % 7 <> 0 AS md_cp, o_orderkey % 11 <> 0 AS dx_cp,
         status IS DISTINCT FROM 'completed' AS todo,
         download_status IS DISTINCT FROM 'completed' AS dl_todo,
         ocr_status IS DISTINCT FROM 'completed' AS ocr_todo,
         docx_conversion_status IS DISTINCT FROM 'completed' AS dx_todo
  FROM st s
),
k AS (
  SELECT *, dl_todo AND NOT dl_ok AS dl_fail FROM j
),
k2 AS (
  SELECT *, NOT dl_fail AND ocr_todo AND NOT ocr_ok AS ocr_fail FROM k
),
k3 AS (
  SELECT *,
         CASE WHEN todo AND dl_todo AND dl_ok THEN 'completed' ELSE download_status END AS new_dl,
         CASE WHEN todo AND NOT dl_fail AND ocr_todo AND ocr_ok THEN 'completed' ELSE ocr_status END AS new_ocr,
         CASE WHEN todo AND NOT dl_fail AND NOT ocr_fail AND dx_todo AND cv_ok THEN 'completed' ELSE docx_conversion_status END AS new_dx
  FROM k2
)
SELECT page_slug, id,
       CASE WHEN NOT todo THEN status WHEN dl_fail OR ocr_fail THEN 'failed'
            WHEN md_cp AND dx_cp AND new_dx IS NOT DISTINCT FROM 'completed' THEN 'completed' ELSE status END AS status,
       new_dl AS download_status, new_ocr AS ocr_status, new_dx AS docx_conversion_status
FROM k3"""

_UPSERT = f"""{_STATE},
old AS (SELECT * FROM st WHERE o_orderstatus IN ('F', 'O')),
new AS (
  SELECT s.page_slug, s.id, s.title_original,
         'https://mirror.example.org/' || s.id || '/' || CAST(CAST(round(o.o_totalprice * 100) AS BIGINT) AS VARCHAR) || '.pdf' AS pdf_url,
         'raw_pdf/' || s.page_slug || '/' || s.id || '.pdf' AS local_pdf_path,
         'processed_docs/' || s.page_slug || '/' || s.id || '.md' AS local_md_path,
         'processed_docs/' || s.page_slug || '/' || s.id || '.docx' AS local_docx_path,
         'pending' AS status
  FROM st s JOIN orders o ON s.o_orderkey = o.o_orderkey WHERE s.o_orderstatus IN ('O', 'P')
),
up AS (
  SELECT coalesce(o.page_slug, n.page_slug) AS page_slug, coalesce(o.id, n.id) AS id,
         CASE WHEN o.id IS NOT NULL THEN o.title_original ELSE n.title_original END AS title_original,
         CASE WHEN n.id IS NOT NULL THEN n.pdf_url ELSE o.pdf_url END AS pdf_url,
         CASE WHEN n.id IS NOT NULL THEN n.local_pdf_path ELSE o.local_pdf_path END AS local_pdf_path,
         CASE WHEN n.id IS NOT NULL THEN n.local_md_path ELSE o.local_md_path END AS local_md_path,
         CASE WHEN n.id IS NOT NULL THEN n.local_docx_path ELSE o.local_docx_path END AS local_docx_path,
         CASE WHEN o.id IS NOT NULL THEN o.status ELSE coalesce(n.status, 'pending') END AS status,
         CASE WHEN o.id IS NOT NULL THEN o.download_status END AS download_status,
         CASE WHEN o.id IS NOT NULL THEN o.error_message END AS error_message
  FROM old o FULL OUTER JOIN new n ON o.page_slug = n.page_slug AND o.id = n.id
)"""

ORACLE["state_upsert"] = f"WITH {_UPSERT} SELECT * FROM up"
ORACLE["incremental_upsert"] = ORACLE["state_upsert"]
ORACLE["new_books"] = f"""WITH {_UPSERT}
SELECT n.page_slug, n.id, n.pdf_url FROM new n ANTI JOIN old o ON n.page_slug = o.page_slug AND n.id = o.id"""

# --- handlers over pages -------------------------------------------------------------------------------------------------

_HANDLER = f"""(CASE WHEN contains({authority('url')}, 'blog.') THEN 'blog_handler'
       WHEN contains({authority('url')}, 'example.com') THEN 'archive_handler'
       WHEN contains({authority('url')}, 'www.') THEN 'www_handler' END)"""

ORACLE["resolve_handler"] = f"SELECT page_id, {_HANDLER} AS handler FROM pages"
ORACLE["register_handler"] = f"""
WITH h AS (SELECT page_id, url, {_HANDLER} AS handler, nullif(regexp_extract({upath('url')}, '/[a-z]{{2}}/([^/]+)', 1), '') AS ident FROM pages)
SELECT page_id, handler,
       coalesce(CASE WHEN handler = 'archive_handler' THEN CASE WHEN ident IS NOT NULL THEN 'https://' || {authority('url')} || '/download/' || ident END
                     WHEN handler = 'blog_handler' THEN regexp_replace(url, '^http:', 'https:') END, url) AS resolved_url
FROM h"""

# --- enrichment over part / events ------------------------------------------------------------------------------------------

ORACLE["slug_cache_join"] = f"""
WITH cache AS (
  SELECT p_partkey AS k, 'cached-' || {fold('p_name')} AS ct,
         CASE WHEN p_partkey % 3 = 0 THEN '' ELSE 'cached-' || {fold('p_brand')} END AS ca
  FROM part WHERE p_name < 'n'
), j AS (
  SELECT p.*, c.ct, c.ca, coalesce(c.ct, '') <> '' AND coalesce(c.ca, '') <> '' AS use FROM part p LEFT JOIN cache c ON p.p_partkey = c.k
)
SELECT p_partkey, CASE WHEN use THEN ct ELSE {fold('p_name')} END AS title_english_slug,
       CASE WHEN use THEN ca ELSE {fold('p_brand')} END AS author_english_slug, use AS from_cache
FROM j"""

ORACLE["enrich_cached"] = f"SELECT p_partkey, CASE WHEN coalesce(p_name, '') = '' THEN '' ELSE {slug("trim(strip_accents(p_name))")} END AS slug FROM part"

ORACLE["ingest_ocr_results"] = """
SELECT user_id AS doc_id, count(*)::BIGINT AS n_jobs, count(*) FILTER (WHERE event_type = 'purchase')::BIGINT AS n_completed,
       bool_and(event_type = 'purchase') AS accepted
FROM events GROUP BY user_id"""

ORACLE["state_fold"] = """
SELECT user_id, event_type AS last_status FROM (
  SELECT user_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rk FROM events
) WHERE rk = 1"""

# --- written and read back ---------------------------------------------------------------------------------------------------

ORACLE["state_roundtrip"] = f"WITH {_STATE} SELECT page_slug, id, status, download_status, ocr_status, docx_conversion_status, pdf_url, error_message FROM st"
ORACLE["merged_text_sink"] = """
SELECT conv_id, string_agg(text || chr(10) || chr(10) || '---' || chr(10) || chr(10), '' ORDER BY turn) AS merged_text
FROM conversations GROUP BY conv_id"""

ORACLE["ocr_output_unpack"] = """
SELECT conv_id,
       arg_min(text, turn) FILTER (WHERE role = 'assistant') AS markdown,
       arg_min('turn_' || CAST(turn AS VARCHAR) || '.md', turn) FILTER (WHERE role = 'assistant') AS markdown_entry,
       count(*) FILTER (WHERE role = 'user')::BIGINT AS n_metadata
FROM conversations GROUP BY conv_id"""

ORACLE["ocr_document_outputs"] = """
WITH c AS (
  SELECT conv_id,
         bool_or(role = 'assistant') AS ok,
         arg_min(text, turn) FILTER (WHERE role = 'assistant') AS md,
         avg((length(text) % 100) / 100.0) FILTER (WHERE role = 'user') AS a,
         count(*) FILTER (WHERE role = 'user' AND (length(text) % 100) / 100.0 < 0.7) AS n,
         array_to_string(list_sort(list_distinct(list(turn) FILTER (WHERE role = 'user' AND (length(text) % 100) / 100.0 < 0.7))), ',') AS pages
  FROM conversations GROUP BY conv_id
)
SELECT conv_id, ok AS ocr_ok, 1::BIGINT AS n_chunks,
       CASE WHEN ok THEN md END AS merged_text,
       CASE WHEN ok THEN round(a, 6) END AS avg_page_confidence,
       (CASE WHEN ok THEN n ELSE 0 END)::BIGINT AS low_confidence_blocks_count,
       CASE WHEN ok THEN coalesce(pages, '') ELSE '' END AS pages_with_low_confidence_blocks
FROM c"""
ORACLE["reset_tool"] = ORACLE["reset_statuses"]

ORACLE["full_run"] = f"""WITH {_NAV},
cfg AS (
  SELECT p.page_id,
         concat_ws(' ', nullif({strip_ws(unescape("regexp_extract(p.html, '(?s)<h1(?:\\s[^>]*)?>([^<]*)</h1>', 1)"))}, ''), 'page', CAST(p.page_id AS VARCHAR)) AS page_name,
         nullif(regexp_extract(p.html, '<html[^>]*\\slang="([^"]*)"', 1), '') AS raw_lang
  FROM pages p
),
books AS (
  SELECT {slug('c.page_name')} AS page_slug, i.item_pos AS book_pos, substr(i.raw_href, 2) AS id,
         {unescape('i.raw_text')} AS title_original, i.raw_href AS pdf_url, coalesce(c.raw_lang, 'kn-IN') AS language
  FROM cfg c JOIN items i ON c.page_id = i.page_id
  WHERE coalesce(c.raw_lang, '') <> 'de'
),
dedup AS (
  SELECT * FROM books QUALIFY row_number() OVER (PARTITION BY page_slug, id ORDER BY book_pos DESC) = 1
),
named AS (
  SELECT *, id || '_' || {combined(slug('title_original'), slug("''"))} || '.pdf' AS fname FROM dedup
)
SELECT page_slug, id, title_original, pdf_url,
       {apath('raw_pdf', 'page_slug', 'id', 'fname')} AS local_pdf_path,
       {apath('processed_docs', 'page_slug', 'id', "replace(fname, '.pdf', '.md')")} AS local_md_path,
       {apath('processed_docs', 'page_slug', 'id', "replace(fname, '.pdf', '.docx')")} AS local_docx_path,
       'pending' AS status, language
FROM named"""

# --- the operators on awkward inputs -----------------------------------------------------------

ORACLE["catalogue_dom_items"] = f"""WITH {_NAV}
SELECT page_id, item_pos::BIGINT AS item_pos, {_TXT} AS title_original, {authority('url')} AS author_original,
       'toc.php?book_id=' || CAST(page_id * 100 + item_pos AS VARCHAR) AS title_href, {unescape('raw_href')} AS pdf_href,
       CAST(page_id * 100 + item_pos AS VARCHAR) AS id
FROM items"""

ORACLE["catalogue_rejects"] = f"""WITH {_ITEMS_ID}
SELECT page_id, item_pos::BIGINT AS item_pos,
       'no ' || concat_ws(', ', CASE WHEN coalesce(title_original, '') = '' THEN 'title' END, CASE WHEN coalesce(pdf_href, '') = '' THEN 'pdf url' END,
                          CASE WHEN coalesce(id, '') = '' THEN 'id' END) AS reason
FROM flag WHERE NOT complete"""

ORACLE["job_rejects"] = """
SELECT event_id, user_id AS doc_id, 'job state is ' || coalesce(event_type, 'missing') AS reason
FROM events WHERE event_type IS DISTINCT FROM 'purchase'"""

ORACLE["low_confidence_details"] = """
WITH blk AS (
  SELECT l_orderkey AS doc_id, l_suppkey % 3 AS part, 'page_' || CAST(l_linenumber AS VARCHAR) || '.json' AS file_name, l_linenumber AS page_num,
         row_number() OVER (PARTITION BY l_orderkey, l_suppkey % 3, l_linenumber ORDER BY l_partkey, l_suppkey, l_quantity, l_shipdate) AS block_pos,
         'b' || CAST(l_partkey AS VARCHAR) || '_' || CAST(l_suppkey AS VARCHAR) AS block_id,
         CASE WHEN l_returnflag <> 'N' THEN l_quantity / 50 END AS confidence, l_returnflag || l_linestatus AS text
  FROM lineitem
)
SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY file_name, part, block_pos)::BIGINT AS detail_pos, page_num, block_id, confidence, text
FROM blk WHERE confidence < 0.7"""

ORACLE["resolved_urls_with_errors"] = f"""WITH {_BEST},
lost AS (SELECT DISTINCT item_id FROM lst WHERE item_id % 13 = 0 OR item_id % 11 = 0)
SELECT o.o_orderkey,
       CASE WHEN l.item_id IS NOT NULL OR coalesce(b.size_error, false) THEN 'https://archive.example.org/download/' || CAST(o.o_orderkey AS VARCHAR) || '/' || CAST(o.o_orderkey AS VARCHAR) || '.pdf'
            WHEN b.best_name IS NOT NULL THEN 'https://archive.example.org/download/' || CAST(o.o_orderkey AS VARCHAR) || '/' || {quote('b.best_name')}
            ELSE 'https://archive.example.org/details/' || CAST(o.o_orderkey AS VARCHAR) END AS resolved_url
FROM orders o LEFT JOIN best b ON o.o_orderkey = b.item_id LEFT JOIN lost l ON o.o_orderkey = l.item_id"""

ORACLE["limit_shared_slug"] = ORACLE["limit_per_page"]
ORACLE["state_roundtrip_pages"] = f"""WITH {_STATE}
SELECT CASE WHEN o_orderkey % 400 = 0 THEN '' ELSE page_slug || '-' || CAST(o_orderkey % 400 AS VARCHAR) END AS page_slug, id, status, pdf_url || '?again' AS pdf_url
FROM st"""
ORACLE["incremental_order"] = ORACLE["state_upsert"]
ORACLE["enrich_cached_again"] = ORACLE["enrich_cached"]

ORACLE["ocr_damaged_archives"] = """
SELECT conv_id, conv_id % 5 <> 0 AND bool_or(role = 'assistant') AS ocr_ok,
       CASE WHEN conv_id % 5 <> 0 AND bool_or(role = 'assistant') THEN arg_min(text, turn) FILTER (WHERE role = 'assistant') END AS merged_text
FROM conversations GROUP BY conv_id"""

ORACLE["binary_file_digest"] = """
SELECT conv_id, sha256(string_agg(text || chr(10) || chr(10) || '---' || chr(10) || chr(10), '' ORDER BY turn)) AS sha256
FROM conversations GROUP BY conv_id"""


# --- rows that were answered wrongly once ---------------------------------------------------------------

ORACLE["upsert_null_ids"] = f"""WITH {_STATE},
keyed AS (SELECT *, min(o_orderkey) OVER (PARTITION BY page_slug) = o_orderkey AS first FROM st)
SELECT page_slug, CASE WHEN NOT first THEN id END AS id, 'https://archive.example.org/details/' || CAST(o_orderkey AS VARCHAR) || '?scan' AS pdf_url,
       CASE WHEN first THEN 'failed' ELSE 'pending' END AS status, CASE WHEN first THEN 'completed' END AS download_status
FROM keyed"""

ORACLE["ocr_repeated_archives"] = """
SELECT conv_id, conv_id % 5 <> 0 AND bool_or(role = 'assistant') AS ocr_ok, 1::BIGINT AS n_chunks,
       CASE WHEN conv_id % 5 <> 0 AND bool_or(role = 'assistant') THEN arg_min(text, turn) FILTER (WHERE role = 'assistant') END AS merged_text
FROM conversations GROUP BY conv_id"""

ORACLE["ocr_rejects"] = """
WITH c AS (SELECT conv_id, bool_or(role = 'assistant') AS md, bool_or(role IN ('assistant', 'user')) AS known FROM conversations GROUP BY conv_id),
a AS (SELECT *, unnest(CASE WHEN conv_id % 3 = 0 THEN ['dir1', 'dir2'] ELSE ['dir2'] END) AS dir FROM c)
SELECT dir || '/' || conv_id || '__0.zip' AS archive_path,
       CASE WHEN conv_id % 3 = 0 AND dir = 'dir2' THEN 'another archive of this chunk was taken'
            WHEN conv_id % 5 = 0 THEN 'archive is damaged' ELSE 'archive has no markdown' END AS reason
FROM a WHERE (conv_id % 5 = 0 OR known) AND (conv_id % 3 = 0 AND dir = 'dir2' OR conv_id % 5 = 0 OR NOT md)"""

_AWKWARD = (
    _BEST.replace(_LISTING, _LISTING + """,
lst2 AS (SELECT item_id, pos, name, CASE WHEN item_id % 5 = 0 AND pos = 0 THEN '99999999999999999999' ELSE size END AS size FROM lst)""")
    .replace("FROM lst WHERE", "FROM lst2 WHERE")
    .replace("AS BIGINT)", "AS HUGEINT)")
)
ORACLE["resolved_urls_awkward_listings"] = f"""WITH {_AWKWARD}
SELECT o.o_orderkey,
       CASE WHEN l.item_id IS NOT NULL AND (o.o_orderkey % 7 = 0 OR coalesce(b.size_error, false)) THEN 'https://archive.example.org/download/' || CAST(o.o_orderkey AS VARCHAR) || '/' || CAST(o.o_orderkey AS VARCHAR) || '.pdf'
            WHEN b.best_name IS NOT NULL THEN 'https://archive.example.org/download/' || CAST(o.o_orderkey AS VARCHAR) || '/' || {quote('b.best_name')}
            ELSE 'https://archive.example.org/details/' || CAST(o.o_orderkey AS VARCHAR) END AS resolved_url
FROM orders o LEFT JOIN best b ON o.o_orderkey = b.item_id LEFT JOIN (SELECT DISTINCT item_id FROM lst) l ON o.o_orderkey = l.item_id"""

# --- files ---------------------------------------------------------------------------------------------

ORACLE["streamed_file_digest"] = "SELECT doc_id, CASE WHEN doc_id % 9 <> 0 THEN sha256(text) END AS sha256 FROM documents"
ORACLE["precheck_files"] = """
SELECT doc_id,
       CASE doc_id % 6 WHEN 1 THEN 'Corrupted PDF file: EOF marker not found' WHEN 2 THEN 'Corrupted PDF file: Cannot read an empty file'
                       WHEN 3 THEN 'Corrupted PDF file: invalid pdf header' WHEN 5 THEN 'PDF file not found.' END AS precheck_error,
       CASE WHEN doc_id % 6 = 0 THEN n_chars % 700 + 1 ELSE 0 END::BIGINT AS page_count
FROM documents"""
ORACLE["placeholder_files"] = """
SELECT d.doc_id,
       CASE WHEN l.quality IS NULL THEN '# OCR Failed for ' || d.doc_id || '.pdf' || chr(10) || chr(10) || 'Error: PDF file not found.' || chr(10) || 'This is a placeholder Markdown file due to PDF pre-check failure.'
            ELSE '# OCR Skipped for ' || d.doc_id || '.pdf' || chr(10) || chr(10) || 'This is a placeholder Markdown file as hosted OCR was disabled for testing purposes.' END AS placeholder
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id"""

# --- streams -----------------------------------------------------------------------------------------------

ORACLE["incremental_batches"] = ORACLE["state_upsert"]
ORACLE["streaming_state_fold"] = ORACLE["state_fold"]

# --- handlers -------------------------------------------------------------------------------------------

ORACLE["resolve_handler_many"] = """
WITH hosts AS (SELECT DISTINCT o_custkey, 'www.c' || o_custkey || '.shelf.test' AS host FROM orders),
hit AS (SELECT h.o_custkey, min(p.p_partkey) AS k FROM hosts h JOIN part p ON contains(h.host, p.p_partkey || '.') GROUP BY h.o_custkey)
SELECT o.o_orderkey, 'module_' || hit.k AS handler FROM orders o LEFT JOIN hit ON o.o_custkey = hit.o_custkey"""
ORACLE["resolve_by_module"] = """
SELECT page_id,
       CASE WHEN page_id % 5 = 0 AND length(url) % 2 = 1 THEN CASE WHEN contains(url, 'http:') THEN replace(url, 'http:', 'https:') ELSE url END || '#secure'
            WHEN page_id % 5 = 1 AND length(url) % 2 = 0 THEN url || '#raising' ELSE url END AS resolved_url,
       CASE WHEN page_id % 5 = 1 AND length(url) % 2 = 1 THEN 'resolver failed: ValueError' WHEN page_id % 5 = 2 THEN 'module has no resolve_pdf_url'
            WHEN page_id % 5 = 3 THEN 'module can''t be loaded: ModuleNotFoundError' END AS resolve_error
FROM pages"""

# --- the full run -----------------------------------------------------------------------------------------

_RUN = f"""{_NAV},
cfg AS (
  SELECT p.page_id, 'list_' || p.page_id AS url_slug,
         concat_ws(' ', nullif({strip_ws(unescape("regexp_extract(p.html, '(?s)<h1(?:\\s[^>]*)?>([^<]*)</h1>', 1)"))}, ''), 'page', CAST(p.page_id AS VARCHAR)) AS page_name,
         nullif(regexp_extract(p.html, '<html[^>]*\\slang="([^"]*)"', 1), '') AS raw_lang
  FROM pages p
),
live AS (SELECT *, CASE WHEN page_id % 3 = 0 THEN url_slug ELSE {slug('page_name')} END AS page_slug, CASE WHEN raw_lang <> 'en' THEN 3 END AS lim FROM cfg WHERE coalesce(raw_lang, '') <> 'de'),
listed AS (
  SELECT c.page_slug, c.lim, i.item_pos,
         CASE WHEN c.page_id % 3 = 0 THEN CAST(i.page_id * 100 + i.item_pos AS VARCHAR) WHEN NOT ends_with(i.raw_href, '7') THEN substr(i.raw_href, 2) END AS id,
         CASE WHEN c.page_id % 3 = 0 THEN {_TXT} ELSE {unescape('i.raw_text')} END AS title_original
  FROM live c JOIN items i ON c.page_id = i.page_id WHERE c.page_id % 9 <> 0
),
kept AS (SELECT * FROM listed WHERE id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY page_slug, id ORDER BY item_pos DESC) = 1)"""

ORACLE["full_run_outcomes"] = f"""WITH {_RUN},
planned AS (SELECT *, row_number() OVER (PARTITION BY page_slug ORDER BY {zfill('id')}, id) <= coalesce(lim, 2147483647) AS todo FROM kept),
steps AS (SELECT *, todo AND length(id) % 2 = 0 AS dl, todo AND length(id) % 2 = 0 AND length(id) % 3 <> 0 AS ocr FROM planned)
SELECT page_slug, id, title_original,
       CASE WHEN NOT todo THEN 'pending' WHEN NOT ocr THEN 'failed' WHEN length(id) % 5 <> 0 THEN 'completed' ELSE 'pending' END AS status,
       CASE WHEN dl THEN 'completed' END AS download_status, CASE WHEN todo AND length(id) % 3 <> 0 AND dl THEN 'completed' END AS ocr_status,
       CASE WHEN ocr THEN 'completed' END AS docx_conversion_status
FROM steps"""

ORACLE["full_run_rejects"] = f"""WITH {_RUN}
SELECT page_slug, id, item_pos::BIGINT AS item_pos, 'listed again later' AS reason FROM listed l
WHERE id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM kept k WHERE k.page_slug = l.page_slug AND k.id = l.id AND k.item_pos = l.item_pos)
UNION ALL SELECT page_slug, NULL, item_pos, 'book has no id' FROM listed WHERE id IS NULL
UNION ALL SELECT page_slug, NULL, NULL, 'list page wasn''t fetched' FROM live WHERE page_id % 9 = 0"""

# --- state by touched pages, texts in containers -----------------------------------------------------------

ORACLE["state_touched_pages"] = f"""WITH {_STATE}
SELECT 'page-' || CAST(o_orderkey % 400 AS VARCHAR) AS page_slug, id, status, pdf_url || CASE WHEN o_orderkey % 400 < 4 THEN '?again' ELSE '' END AS pdf_url FROM st"""
ORACLE["packed_text_sink"] = """
SELECT conv_id, count(*)::BIGINT AS n_parts, string_agg(text || chr(10) || chr(10) || '---' || chr(10) || chr(10), '' ORDER BY turn) AS merged_text
FROM conversations GROUP BY conv_id"""
