"""DuckDB SQL for the queries of this folder that SQL can express.

Not here, and tested against plain versions in ``tests/llm`` instead: models (toxicity, personal
data), XXH64 fingerprints, token ids and counts, compact windows, and the license rules' labels.
"""

from __future__ import annotations

ORACLE: dict[str, str] = {}

# ---- 3: mixing ------------------------------------------------------------------------------


def _round(k: int) -> str:
    """One round of filling: candidates fit the room; the first by rank whose words fit are taken."""
    return f"""
c{k} AS (SELECT *, p > 0 AND NOT done AND size <= room AS fits FROM r{k - 1}),
s{k} AS (SELECT *, sum(size) OVER (PARTITION BY source, fits ORDER BY rank RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto FROM c{k}),
t{k} AS (SELECT *, fits AND upto <= room AS now FROM s{k}),
r{k} AS (
  SELECT doc_id, source, size, source_size, target, copies, p, rank, done OR now AS done,
         room - coalesce(sum(CASE WHEN now THEN size END) OVER (PARTITION BY source), 0) AS room
  FROM t{k}
)"""


ORACLE["op3_mixing"] = (
    r"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents
),
drawn AS (
  SELECT *, (('0x' || substr(md5(concat_ws('|', CAST(doc_id AS VARCHAR), source, CAST(size AS VARCHAR))), 1, 13))::BIGINT + 0.5::DOUBLE) / 4503599627370496::DOUBLE AS u FROM sized
),
sources AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
weighed AS (
  SELECT *, [3, 1, 2][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INTEGER] AS weight, source_size * 2 AS cap FROM sources
),
levels AS (
  SELECT *, ((sum(source_size) OVER ())::DOUBLE * 1.5::DOUBLE
             - coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE)
            / (sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS level
  FROM weighed
),
goals AS (SELECT source, source_size, least(cap::DOUBLE, (max(level) OVER ()) * weight) AS target FROM levels),
whole AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::INTEGER ELSE 0 END AS copies FROM goals),
rooms AS (SELECT *, target - copies * source_size AS room FROM whole),
joined AS (
  SELECT d.doc_id, d.source, d.size, d.u, r.source_size, r.target, r.copies, r.room
  FROM drawn d JOIN rooms r ON d.source IS NOT DISTINCT FROM r.source
),
by_size AS (
  SELECT source, size, room, count(*) * size AS words, count(*)::HUGEINT * size * size AS squares
  FROM joined WHERE size > 0 AND size <= room GROUP BY source, size, room
),
levels_of AS (
  SELECT source, room, words,
         (room - coalesce(sum(words) OVER (PARTITION BY source ORDER BY size DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE)
         / (sum(squares) OVER (PARTITION BY source ORDER BY size DESC ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS scale
  FROM by_size
),
scales AS (SELECT source, CASE WHEN sum(words)::DOUBLE <= max(room) THEN 1.0::DOUBLE ELSE max(scale) END AS scale FROM levels_of GROUP BY source),
odds AS (
  SELECT j.*, least(1.0::DOUBLE, coalesce(s.scale, 0.0::DOUBLE) * j.size::DOUBLE) AS p
  FROM joined j LEFT JOIN scales s ON j.source IS NOT DISTINCT FROM s.source
),
r0 AS (
  SELECT doc_id, source, size, source_size, target, copies, p, false AS done, room,
         CASE WHEN p > 0 THEN u / (1 - u) * ((1 - p) / p) END AS rank
  FROM odds
),"""
    + ",".join(_round(k) for k in range(1, 5))
    + """
SELECT doc_id, size, source_size, target, (size * (copies + done::INTEGER))::BIGINT AS taken, (copies + done::INTEGER)::INTEGER AS copies FROM r4"""
)

# ---- 8: decontamination -----------------------------------------------------------------------

_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

ORACLE["op8_decontamination"] = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
spots AS (SELECT item_id, w, least(13, len(w)) AS n, unnest(generate_series(1, len(w) - least(13, len(w)) + 1)) AS i FROM b WHERE len(w) > 0),
wins AS (SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS win FROM spots),
lens AS (SELECT DISTINCT n FROM wins),
places AS (SELECT rid, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i FROM d, lens WHERE len(w) >= n),
met AS (SELECT p.rid, p.i, p.n, x.item_id FROM places p JOIN wins x ON x.n = p.n AND x.win = array_to_string(p.w[p.i:p.i + p.n - 1], ' ')),
spans AS (SELECT DISTINCT rid, i, n FROM met),
covered AS (SELECT rid, unnest(generate_series(i, i + n - 1)) AS pos FROM spans),
hit AS (SELECT rid, count(DISTINCT pos) AS n_hit FROM covered GROUP BY rid),
ids AS (SELECT DISTINCT rid, CAST(item_id AS VARCHAR) AS item FROM met WHERE item_id IS NOT NULL),
items AS (SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names FROM ids GROUP BY rid)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(h.n_hit, 0)::BIGINT AS n_hit, coalesce(t.n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(t.names, '')) AS items_sha256, coalesce(h.n_hit, 0) > 0 AND 20 * coalesce(h.n_hit, 0) >= len(d.w) AS contaminated
FROM d LEFT JOIN hit h ON d.rid = h.rid LEFT JOIN items t ON d.rid = t.rid"""

# ---- 7: quality -------------------------------------------------------------------------------

_CLASSES = (
    "bcdfghjklmnpqrstvwxyz", "aeiou", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", None, ".,;:''\"-", "!?()[]{}/\\+=~^`@_#*$%&|<>",
)
_SPACES = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


def _count(chars: str | None) -> str:
    own = _SPACES if chars is None else f"'{chars}'"
    return f"(length(t) - length(translate(t, {own}, '')))::BIGINT"


def _divergence(p: str, q: str) -> str:
    """Jensen-Shannon distance of two share columns, as a sum over a document's rows."""
    part = lambda a: f"(CASE WHEN {a} > 0 THEN {a} * log2({a} / (({p} + {q}) / 2)) ELSE 0 END)"
    return f"sqrt(greatest(0, sum({part(p)} + {part(q)}) / 2))"


ORACLE["op7_quality"] = rf"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, lang, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w, {_WORDS} AS names
  FROM documents
),
grams AS (SELECT rid, i, array_to_string(w[i:i + 7], ' ') AS g FROM (SELECT rid, w, unnest(generate_series(1, len(w) - 7)) AS i FROM d WHERE len(w) >= 8)),
twice AS (SELECT rid, g FROM grams GROUP BY rid, g HAVING count(*) > 1),
again AS (SELECT rid, unnest(generate_series(i, i + 7)) AS pos FROM grams JOIN twice USING (rid, g)),
repeated AS (SELECT rid, count(DISTINCT pos) AS n FROM again GROUP BY rid),
lines AS (SELECT rid, unnest(string_split(t, chr(10))) AS line FROM d),
dups AS (SELECT rid, count(*) - count(DISTINCT line) AS n FROM lines WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY rid),
base AS (
  SELECT d.rid, d.doc_id, d.lang, len(w)::BIGINT AS n_words, coalesce(length(array_to_string(w, '')), 0)::BIGINT AS word_chars,
         (length(t) - length(translate(t, '#*$%&|<>', '')))::BIGINT AS n_symbols, coalesce(dups.n, 0)::BIGINT AS n_dup_lines,
         coalesce(repeated.n, 0)::BIGINT AS n_repeat_words, length(t) AS n_chars
  FROM d LEFT JOIN dups ON d.rid = dups.rid LEFT JOIN repeated ON d.rid = repeated.rid
),
listed AS (SELECT rid, lang, length(t) AS total, [{", ".join(_count(c) for c in _CLASSES)}] AS counts FROM d),
classes AS (
  SELECT rid, lang, k, CASE WHEN k <= 7 THEN counts[k] ELSE total - list_sum(counts) END AS n FROM listed, generate_series(1, 8) AS g(k)
),
class_refs AS (SELECT lang, k, sum(n) / greatest(1, sum(sum(n)) OVER (PARTITION BY lang)) AS share FROM classes GROUP BY lang, k),
char_distance AS (
  SELECT rid, {_divergence("p", "share")} AS x FROM (
    SELECT c.rid, c.n / greatest(1, sum(c.n) OVER (PARTITION BY c.rid)) AS p, r.share
    FROM classes c JOIN class_refs r ON c.lang IS NOT DISTINCT FROM r.lang AND c.k = r.k)
  GROUP BY rid
),
words AS (SELECT rid, lang, unnest(names) AS word FROM d),
counted AS (SELECT lang, word, count(*) AS n FROM words GROUP BY ALL),
totals AS (SELECT *, sum(n) OVER (PARTITION BY lang) AS total FROM counted),
common AS (SELECT lang, word, n / total AS share FROM totals WHERE n >= 0.01::DOUBLE * total),
rest AS (SELECT lang, '' AS word, greatest(0, 1 - sum(share)) AS share FROM common GROUP BY lang),
word_refs AS (SELECT * FROM common UNION ALL SELECT * FROM rest),
own AS (SELECT w.rid, w.word, count(*) AS n FROM words w JOIN common c ON w.lang IS NOT DISTINCT FROM c.lang AND w.word = c.word GROUP BY w.rid, w.word),
held AS (SELECT b.rid, r.word, r.share, coalesce(o.n, 0) AS n, b.n_words FROM base b JOIN word_refs r ON b.lang IS NOT DISTINCT FROM r.lang LEFT JOIN own o ON b.rid = o.rid AND r.word = o.word),
filled AS (SELECT rid, word, share, CASE WHEN word = '' THEN greatest(0, n_words - sum(n) OVER (PARTITION BY rid)) ELSE n END AS n FROM held),
word_distance AS (
  SELECT rid, {_divergence("p", "share")} AS x FROM (SELECT rid, share, n / greatest(1, sum(n) OVER (PARTITION BY rid)) AS p FROM filled) GROUP BY rid
),
judged AS (
  SELECT b.*, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
         (n_chars >= 200 AND c.x > 0.31::DOUBLE) OR (n_words >= 60 AND coalesce(w.x, 0) > 0.28::DOUBLE) AS far
  FROM base b JOIN char_distance c ON b.rid = c.rid LEFT JOIN word_distance w ON b.rid = w.rid
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND NOT far AS kept FROM judged"""


def _crc32(expr: str) -> str:
    """Unsigned CRC-32 of an ASCII string, byte by byte and bit by bit."""
    bits = "list_reduce(list_prepend(xor(c, b), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda v, z: xor(v >> 1, 3988292384::BIGINT * (v & 1)))"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split({expr}, ''), lambda x: ascii(x)::BIGINT)), lambda c, b: {bits}), 4294967295::BIGINT)"


ORACLE["op11_periodic_runs"] = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w, {_crc32("doc_id::VARCHAR")} AS h FROM documents),
planted AS (SELECT *, len(w) AS n, (h // 10) % greatest(1, len(w)) AS a, (h // 10) % 8 + 3 AS most FROM d),
laid AS (SELECT rid, doc_id, n, CASE WHEN h % 10 = 0 AND n > 0 THEN list_transform(range(n), lambda i: w[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // most) END]) ELSE w END AS w FROM planted),
words AS (SELECT rid, n, i, w[i + 1] AS word FROM (SELECT rid, n, w, unnest(range(n)) AS i FROM laid)),
equal AS (SELECT x.rid, y.i - x.i AS q, x.i FROM words x JOIN words y ON x.rid = y.rid AND x.word = y.word AND y.i > x.i AND 4 * (y.i - x.i) <= x.n),
islands AS (SELECT rid, q, i, i - row_number() OVER (PARTITION BY rid, q ORDER BY i) AS island FROM equal),
stretches AS (SELECT rid, q, min(i) AS s, max(i) + 1 + q AS e FROM islands GROUP BY rid, q, island HAVING count(*) + q >= greatest(6, 4 * q)),
runs AS (SELECT rid, s, e, q FROM stretches r WHERE NOT EXISTS (SELECT 1 FROM stretches o WHERE o.rid = r.rid AND o.q < r.q AND o.s <= r.s AND o.e >= r.e)),
listed AS (SELECT rid, count(*) AS n_runs, string_agg(s || ',' || (e - s) || ',' || q || chr(10), '' ORDER BY s, q) AS lines FROM runs GROUP BY rid),
ranked AS (SELECT rid, s, e - s AS length, q, row_number() OVER (PARTITION BY rid ORDER BY (e - s)::DOUBLE / q DESC, s, q) AS rn FROM runs),
gone AS (SELECT DISTINCT rid, unnest(range(s + q, e)) AS i FROM runs),
kept AS (SELECT w.rid, string_agg(w.word, ' ' ORDER BY w.i) AS t FROM words w ANTI JOIN gone g ON w.rid = g.rid AND w.i = g.i GROUP BY w.rid)
SELECT l.doc_id, coalesce(x.n_runs, 0) AS n_runs, r.s AS start, r.length, r.q AS period, 1000 * r.length // r.q AS exponent_milli,
       sha256(coalesce(x.lines, '')) AS runs_sha256, sha256(coalesce(k.t, '')) AS collapsed_sha256
FROM laid l LEFT JOIN listed x ON l.rid = x.rid LEFT JOIN ranked r ON l.rid = r.rid AND r.rn = 1 LEFT JOIN kept k ON l.rid = k.rid"""

ORACLE["op12_prefix_trie"] = f"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
numbered AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos FROM t),
convs AS (SELECT conv_id, {_crc32("conv_id::VARCHAR")} % 9 AS h FROM (SELECT DISTINCT conv_id FROM t)),
laid AS (
  SELECT c.conv_id, n.pos, n.role, n.text FROM convs c JOIN numbered n ON n.conv_id = c.conv_id - c.conv_id % 5 AND n.pos <= c.h
  UNION ALL SELECT c.conv_id, n.pos + 8, n.role, n.text FROM convs c JOIN numbered n ON n.conv_id = c.conv_id AND n.pos > c.h
),
turns AS (SELECT conv_id, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY pos) AS depth FROM laid),
path AS (
  SELECT conv_id, depth, strlen(text) AS size, sha256(string_agg(strlen(role) || ':' || strlen(text) || ':' || role || text, '') OVER (PARTITION BY conv_id ORDER BY depth)) AS node FROM turns
  UNION ALL SELECT conv_id, 0, 0, '' FROM convs
),
nodes AS (SELECT node, depth, min(conv_id) AS conv_id, count(*) AS n_convs, max(size) AS size FROM path GROUP BY node, depth),
linked AS (SELECT n.*, p.node AS parent FROM nodes n LEFT JOIN path p ON p.conv_id = n.conv_id AND p.depth = n.depth - 1),
children AS (SELECT parent, count(*) AS n_children FROM linked WHERE parent IS NOT NULL GROUP BY parent),
own AS (SELECT l.*, coalesce(c.n_children, 0) AS n_children FROM linked l LEFT JOIN children c ON c.parent = l.node),
subtree AS (
  SELECT p.node, count(*) FILTER (WHERE u.n_children = 0) AS n_leaves, sum((u.n_convs - 1) * u.size)::BIGINT AS saved_tokens
  FROM own u JOIN path p ON p.conv_id = u.conv_id AND p.depth <= u.depth GROUP BY p.node
),
ends AS (SELECT node, string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) AS ids FROM (SELECT conv_id, arg_max(node, depth) AS node FROM path GROUP BY conv_id) GROUP BY node)
SELECT o.conv_id, o.depth, p.conv_id AS parent_conv_id, o.n_convs, o.n_children, s.n_leaves, s.saved_tokens, sha256(coalesce(e.ids, '')) AS ends_sha256
FROM own o JOIN subtree s ON s.node = o.node LEFT JOIN nodes p ON p.node = o.parent LEFT JOIN ends e ON e.node = o.node"""
