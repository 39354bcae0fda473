"""Registered queries: one per SURVEY §2 key, each ``(spark, sf_dir) -> DataFrame``.

Arrays are emitted as sorted, joined strings and averages are rounded to 6 places so
the results compare value-for-value with the SQL in ``plans.oracle``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusflow.functions import html as H
from corpusflow.functions import text as TX
from corpusflow.functions import urls as U
from corpusflow.operators import catalogue as CAT
from corpusflow.operators import chunks as CH
from corpusflow.operators import enrich as EN
from corpusflow.operators import quality as Q
from corpusflow.operators import resolve as RS
from corpusflow.operators import state as ST
from corpusflow.operators.ranking import ensure_parallelism
from corpusflow.plans import inputs as IN
from corpusflow.plans.providers import fold_provider
from corpusflow.schemas import STATE_COLUMNS
from corpusflow.sources import catalogue as SC
from corpusflow.sources import config as CFG
from corpusflow.sources import files as FS

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(key: str):
    def deco(fn: Query) -> Query:
        QUERIES[key] = fn
        return fn

    return deco


def _docs(spark, sf, *cols):
    """Documents with the given columns; whole texts get a parallelism floor."""
    d = IN.table(spark, sf, "documents").select("doc_id", *cols)
    return ensure_parallelism(d) if "text" in cols else d


def _pages(spark, sf, *cols):
    p = IN.table(spark, sf, "pages").select("page_id", *cols)
    return ensure_parallelism(p) if "html" in cols else p


# --- flagship --------------------------------------------------------------------------------


@query("corpus_readiness")
def corpus_readiness(spark, sf):
    """Per language: documents, OCR chunks (500-unit parts), distinct content digests,
    labelled documents and documents still to process (status 'completed' iff quality 1)."""
    d = _docs(spark, sf, "text", "lang", "n_chars")
    lab = IN.table(spark, sf, "labels").select("doc_id", "quality")
    j = d.join(lab, "doc_id", "left")
    nchunks = F.when(F.col("n_chars") > CH.PAGE_LIMIT, F.ceil(F.col("n_chars") / CH.PAGE_LIMIT)).otherwise(F.lit(1))
    status = F.when(F.col("quality") == 1, F.lit("completed"))
    return j.groupBy("lang").agg(
        F.count(F.lit(1)).cast("bigint").alias("documents"),
        F.sum(nchunks).cast("bigint").alias("chunks"),
        F.countDistinct(F.sha2("text", 256)).cast("bigint").alias("distinct_digests"),
        F.count("quality").cast("bigint").alias("labelled"),
        F.count_if(ST.not_equal_null_safe(status, "completed")).cast("bigint").alias("pending"),
    )


# --- P: projections over documents -----------------------------------------------------------


@query("slugify")
def q_slugify(spark, sf):
    return _docs(spark, sf, "text").select("doc_id", TX.slugify("text").alias("slug"))


@query("slugify_admin")
def q_slugify_admin(spark, sf):
    return _docs(spark, sf, "text").select("doc_id", TX.slugify_admin("text").alias("slug"))


@query("ellipsize")
def q_ellipsize(spark, sf):
    return _docs(spark, sf, "text").select("doc_id", TX.ellipsize("text", TX.SLUG_MAX).alias("short_text"))


@query("ascii_fold")
def q_ascii_fold(spark, sf):
    return _docs(spark, sf, "text").select("doc_id", TX.ascii_fold("text").alias("slug"))


@query("url_quote")
def q_url_quote(spark, sf):
    return _docs(spark, sf, "text").select("doc_id", U.url_quote("text").alias("quoted"))


@query("zfill_id")
def q_zfill(spark, sf):
    p = IN.table(spark, sf, "part").select("p_partkey")
    return p.select(
        "p_partkey",
        TX.zfill_id(F.col("p_partkey").cast("string")).alias("zid"),
        TX.zfill_id((F.col("p_partkey") - 50).cast("string")).alias("zid_signed"),
    )


def _inline_books(spark, sf, *extra) -> DataFrame:
    d = _docs(spark, sf, "text", "lang", "source", *extra)
    books = d.select(
        "doc_id",
        *extra,
        TX.slugify("lang").alias("page_slug"),
        F.concat(F.lit("D"), F.col("doc_id").cast("string")).alias("id"),
        F.col("text").alias("title_original"),
        F.col("source").alias("author_original"),
    )
    return CAT.inline_book_rows(books)


@query("book_paths")
def q_book_paths(spark, sf):
    return _inline_books(spark, sf).select("doc_id", "local_pdf_path", "local_md_path", "local_docx_path")


@query("scraped_paths")
def q_scraped_paths(spark, sf):
    d = _docs(spark, sf, "text", "lang", "source")
    items = d.select(
        "doc_id",
        TX.slugify("lang").alias("page_slug"),
        F.concat(F.lit("D"), F.col("doc_id").cast("string")).alias("id"),
        F.col("text").alias("title_original"),
        F.col("source").alias("author_original"),
    )
    rows = CAT.scraped_book_rows(items, TX.slugify("title_original"), TX.slugify("author_original"))
    return rows.select("doc_id", "title_english_slug", "author_english_slug", "local_pdf_path", "local_md_path", "local_docx_path")


@query("swap_suffix")
def q_swap_suffix(spark, sf):
    b = _inline_books(spark, sf)
    name = TX.basename("local_pdf_path")
    return b.select("doc_id", TX.swap_suffix(name, ".md").alias("md_name"), TX.swap_suffix(name, ".docx").alias("docx_name"))


@query("artifact_layout")
def q_artifact_layout(spark, sf):
    b = CAT.sd_card_paths(_inline_books(spark, sf))
    return b.select("doc_id", "local_pdf_path", "sd_pdf_path", "sd_md_path", "sd_docx_path")


@query("basename")
def q_basename(spark, sf):
    b = _inline_books(spark, sf)
    return b.select("doc_id", TX.basename("local_pdf_path").alias("file_name"), TX.stem(TX.basename("local_pdf_path")).alias("file_stem"))


# --- P: URLs over pages ----------------------------------------------------------------------


@query("page_slug")
def q_page_slug(spark, sf):
    return _pages(spark, sf, "url").select("page_id", U.page_slug("url").alias("page_slug"))


@query("page_slug_admin")
def q_page_slug_admin(spark, sf):
    return _pages(spark, sf, "url").select("page_id", U.page_slug_admin("url").alias("page_slug"))


@query("state_name")
def q_state_name(spark, sf):
    return _pages(spark, sf, "url").select("page_id", U.state_name(U.page_slug("url")).alias("state_file"))


@query("url_authority")
def q_url_authority(spark, sf):
    return _pages(spark, sf, "url").select("page_id", U.url_authority("url").alias("authority"), U.url_path("url").alias("path"))


@query("item_identifier")
def q_item_identifier(spark, sf):
    return _pages(spark, sf, "url").select("page_id", U.item_identifier("url", IN.LANG_SEGMENT).alias("item_id"))


def _nav_items(spark, sf) -> DataFrame:
    p = _pages(spark, sf, "url", "html")
    return SC.regex_items(p, "html", IN.NAV_LINK, {"pdf_href": 1, "title_original": 2})


@query("url_join")
def q_url_join(spark, sf):
    it = _nav_items(spark, sf)
    return it.select("page_id", F.col("item_pos").cast("bigint").alias("item_pos"), F.col("pdf_href").alias("href"), U.url_join("url", "pdf_href").alias("abs_url"))


# --- S3: catalogue ----------------------------------------------------------------------------


@query("catalogue_items")
def q_catalogue_items(spark, sf):
    it = _nav_items(spark, sf)
    return it.select("page_id", F.col("item_pos").cast("bigint").alias("item_pos"), "title_original", "pdf_href")


@query("catalogue_fields")
def q_catalogue_fields(spark, sf):
    p = _pages(spark, sf, "html")
    return p.select("page_id", H.tag_text("html", "title").alias("title"), H.tag_text("html", "h1").alias("h1"), H.html_lang("html").alias("lang"))


@query("catalogue_ids")
def q_catalogue_ids(spark, sf):
    p = _pages(spark, sf, "url")
    pats = SC.ID_PATTERNS + [f"/{IN.LANG_SEGMENT}/(\\d+[A-Z]?)"]
    return p.select("page_id", SC.catalogue_id("url", "url", pats).alias("id"))


def _items_with_id(spark, sf) -> DataFrame:
    it = _nav_items(spark, sf)
    return it.withColumn("id", F.regexp_extract("pdf_href", r"^/([^,/?#]+)$", 1))


@query("complete_items")
def q_complete_items(spark, sf):
    it = _items_with_id(spark, sf)
    return it.select("page_id", F.col("item_pos").cast("bigint").alias("item_pos"), "id", SC.complete_items(it).alias("complete"))


@query("catalogue_counts")
def q_catalogue_counts(spark, sf):
    it = _items_with_id(spark, sf)
    return CAT.catalogue_counts(it, "page_id", SC.complete_items(it))


# --- S1 / F1: config ---------------------------------------------------------------------------


def _config_pages(spark, sf) -> DataFrame:
    cfg = IN.config_json(spark, sf).select("page_id", CFG.parse_pages("config").alias("pages"))
    return CFG.config_pages(cfg, keep=["page_id"])


@query("config_flatten")
def q_config_flatten(spark, sf):
    books = CFG.inline_books(CFG.enabled_pages(_config_pages(spark, sf)))
    return books.select(
        "page_id",
        F.col("book_pos").cast("bigint").alias("book_pos"),
        "page_name",
        "page_language",
        # null and 0 both mean "no limit"; shown as 0 so the column has no nulls
        F.coalesce(F.col("page_limit"), F.lit(0)).alias("page_limit"),
        "page_slug",
        "id",
        "title_original",
        "author_original",
        "pdf_url",
    )


@query("enabled_pages")
def q_enabled_pages(spark, sf):
    p = CFG.enabled_pages(_config_pages(spark, sf))
    return p.select("page_id", "page_name", "page_language", "page_slug")


# --- S4 / W1 / W4 / F3 / J5: listings ---------------------------------------------------------


def _listing(spark, sf) -> DataFrame:
    return FS.file_listing(IN.listing_json(spark, sf), "metadata", ["item_id"])


@query("file_listing")
def q_file_listing(spark, sf):
    return _listing(spark, sf).select("item_id", F.col("pos").cast("bigint").alias("pos"), "name", "size")


@query("pdf_files")
def q_pdf_files(spark, sf):
    return CAT.pdf_files(_listing(spark, sf)).select("item_id", F.col("pos").cast("bigint").alias("pos"), "name")


@query("best_file")
def q_best_file(spark, sf):
    return RS.best_file(_listing(spark, sf), "item_id")


@query("first_entry")
def q_first_entry(spark, sf):
    li = _listing(spark, sf)
    return CH.first_entry(li, ["item_id"], "pos", "name", F.col("name").endswith(".txt"), "first_txt")


@query("resolved_urls")
def q_resolved_urls(spark, sf):
    o = IN.table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    seg = F.when(F.col("o_orderstatus") == "P", F.lit("/stream/")).otherwise(F.lit("/details/"))
    cat = o.select("o_orderkey", F.concat(F.lit(IN.ARCHIVE_HOST), seg, F.col("o_orderkey").cast("string")).alias("url"))
    best = RS.best_file(_listing(spark, sf), "item_id").withColumn("item_id", F.col("item_id").cast("string"))
    return RS.resolved_urls(cat, "url", best, "item_id", IN.DOWNLOAD_BASE).select("o_orderkey", "resolved_url")


# --- S7 / F5 / A1 / A7 / O2 / U2: page metadata -------------------------------------------------


def _blocks(spark, sf) -> DataFrame:
    return FS.block_rows(IN.metadata_pages(spark, sf), "metadata", "file_name", ["doc_id", "part"])


@query("block_explode")
def q_block_explode(spark, sf):
    b = _blocks(spark, sf)
    return b.select("doc_id", "part", "file_name", "page_num", F.col("block_pos").cast("bigint").alias("block_pos"), "block_id", "confidence")


@query("low_confidence_blocks")
def q_low_blocks(spark, sf):
    b = Q.low_confidence_blocks(_blocks(spark, sf))
    return b.select("doc_id", "part", "file_name", "page_num", F.col("block_pos").cast("bigint").alias("block_pos"), "block_id", "confidence")


@query("confidence_metrics")
def q_confidence_metrics(spark, sf):
    docs = IN.table(spark, sf, "orders").select(F.col("o_orderkey").alias("doc_id"))
    m = Q.confidence_metrics(_blocks(spark, sf), docs, "doc_id")
    return m.select(
        "doc_id",
        F.round("avg_page_confidence", 6).alias("avg_page_confidence"),
        "low_confidence_blocks_count",
        F.array_join(F.col("pages_with_low_confidence_blocks").cast("array<string>"), ",").alias("pages_with_low_confidence_blocks"),
    )


@query("distinct_low_pages")
def q_distinct_low_pages(spark, sf):
    return Q.distinct_low_pages(_blocks(spark, sf), "doc_id")


def _metadata_page_rows(spark, sf) -> DataFrame:
    mp = IN.metadata_pages(spark, sf)
    parsed = mp.select("doc_id", "part", "file_name", F.from_json("metadata", FS.PAGE_METADATA).alias("_p"))
    return parsed.select(
        "doc_id",
        "part",
        "file_name",
        F.coalesce(F.col("_p.page_num").try_cast("int"), FS.page_num_from_name("file_name")).alias("page_num"),
        F.size("_p.blocks").cast("bigint").alias("n_blocks"),
    )


@query("merge_metadata")
def q_merge_metadata(spark, sf):
    return Q.merge_metadata([_metadata_page_rows(spark, sf)])


@query("sort_metadata")
def q_sort_metadata(spark, sf):
    rows = _metadata_page_rows(spark, sf).select("doc_id", "part", "file_name")
    return Q.sort_metadata(rows, "doc_id", "file_name", tie=["part"])


# --- C / K4: chunks over documents ---------------------------------------------------------------

def _whole_part():
    """The operators mark an unsplit document with a null part; the views show it as part
    0 (the same convention as OCR result archive names), so the column has no nulls."""
    return F.coalesce(F.col("part"), F.lit(0).cast("bigint")).alias("part")


@query("chunk_plan")
def q_chunk_plan(spark, sf):
    return CH.chunk_plan(_docs(spark, sf, "n_chars"), "n_chars").select("doc_id", _whole_part(), "start_page", "end_page")


@query("chunk_names")
def q_chunk_names(spark, sf):
    b = _inline_books(spark, sf, "n_chars")
    b = b.withColumn("stem", TX.stem(TX.basename("local_pdf_path")))
    return CH.chunk_names(CH.chunk_plan(b, "n_chars"), "stem").select("doc_id", _whole_part(), "chunk_pdf", "chunk_md")


@query("chunk_slices")
def q_chunk_slices(spark, sf):
    plan = CH.chunk_plan(_docs(spark, sf, "text", "n_chars"), "n_chars")
    return CH.chunk_slices(plan, "text").select("doc_id", _whole_part(), "slice")


def _precheck(d: DataFrame) -> DataFrame:
    k = F.col("doc_id")
    err = CH.precheck_error(k % 4 != 3, F.col("parse_error"), k % 2 == 0)
    return d.withColumn("parse_error", F.when(k % 17 == 0, F.lit("EOF marker not found"))).withColumn("precheck_error", err).withColumn(
        "page_count", F.when(F.col("precheck_error").isNull(), F.col("n_chars")).otherwise(F.lit(0).cast("bigint"))
    )


@query("precheck_triage")
def q_precheck_triage(spark, sf):
    return _precheck(_docs(spark, sf, "n_chars")).select("doc_id", "precheck_error", "page_count")


@query("precheck_placeholder")
def q_precheck_placeholder(spark, sf):
    b = _inline_books(spark, sf, "n_chars").withColumn("file_name", TX.basename("local_pdf_path"))
    pc = _precheck(b).filter(F.col("precheck_error").isNotNull())
    return pc.select("doc_id", CH.failed_placeholder("file_name", "precheck_error").alias("placeholder"))


# --- J6 / A2 / A3: chunk outputs over conversations ----------------------------------------------


def _chunk_outputs(spark, sf) -> DataFrame:
    c = IN.table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    plan = c.select("conv_id", "turn")
    texts = c.filter(F.length("text") % 13 != 0).select("conv_id", "turn")
    metas = c.filter(~((F.col("role") == "assistant") & (F.length("text") % 11 == 0))).select("conv_id", "turn")
    return CH.chunk_outputs(plan, texts, metas, ["conv_id", "turn"])


@query("chunk_outputs_join")
def q_chunk_outputs_join(spark, sf):
    return _chunk_outputs(spark, sf).select("conv_id", "turn", "has_text", "has_metadata", "good")


@query("document_success")
def q_document_success(spark, sf):
    return CH.document_success(_chunk_outputs(spark, sf), "conv_id")


@query("ordered_merge")
def q_ordered_merge(spark, sf):
    ok = CH.document_success(_chunk_outputs(spark, sf), "conv_id").filter("success").select("conv_id")
    c = IN.table(spark, sf, "conversations").select("conv_id", "turn", "text")
    return CH.ordered_merge(c.join(ok, "conv_id", "left_semi"), "conv_id", "turn", "text")


# --- S5 / J4: digests ------------------------------------------------------------------------------


def _digests(spark, sf) -> DataFrame:
    d = _docs(spark, sf, "text")
    k = F.col("doc_id")
    present = k % 4 != 3
    cur = F.when(present, F.sha2("text", 256))
    rec = F.when(k % 4 == 1, F.lit(None).cast("string")).when(k % 4 == 2, F.sha2(F.concat("text", F.lit("x")), 256)).otherwise(F.sha2("text", 256))
    return d.select("doc_id", present.alias("present"), cur.alias("sha256"), rec.alias("recorded"))


@query("file_digest")
def q_file_digest(spark, sf):
    return _digests(spark, sf).select("doc_id", "sha256")


@query("checksum_verify")
def q_checksum_verify(spark, sf):
    d = _digests(spark, sf).withColumn("verdict", ST.checksum_verdict("present", "sha256", "recorded"))
    return d.select("doc_id", "verdict", ST.hash_after_check("verdict", "sha256", "recorded").alias("pdf_sha256_hash"))


# --- state over orders --------------------------------------------------------------------------------


def _state(spark, sf) -> DataFrame:
    return IN.book_state(spark, sf).select(*STATE_COLUMNS)


@query("pending_books")
def q_pending_books(spark, sf):
    return ST.pending_books(_state(spark, sf)).select("page_slug", "id", "status")


@query("resettable")
def q_resettable(spark, sf):
    s = _state(spark, sf)
    return s.filter(ST.resettable(s)).select("page_slug", "id", "status")


@query("stage_todo")
def q_stage_todo(spark, sf):
    s = _state(spark, sf)
    return s.select("page_slug", "id", F.array_join(ST.remaining_stages(s), ",").alias("remaining"))


@query("reset_statuses")
def q_reset_statuses(spark, sf):
    r = ST.reset_statuses(_state(spark, sf))
    return r.select("page_slug", "id", "status", "download_status", "ocr_status", "docx_conversion_status", "error_message")


@query("reset_counts")
def q_reset_counts(spark, sf):
    return ST.reset_counts(_state(spark, sf))


def _limited(spark, sf) -> DataFrame:
    return ST.limit_per_page(ST.pending_books(_state(spark, sf)), IN.page_limits(spark, sf))


@query("limit_per_page")
def q_limit_per_page(spark, sf):
    return _limited(spark, sf).select("page_slug", "id", "ordinal")


@query("progress_index")
def q_progress_index(spark, sf):
    return _limited(spark, sf).select("page_slug", "id", "ordinal", "total")


@query("pending_counts")
def q_pending_counts(spark, sf):
    return ST.pending_counts(_limited(spark, sf)).withColumn("n_to_process", F.col("n_to_process").cast("bigint"))


@query("resume_plan")
def q_resume_plan(spark, sf):
    r = ST.resume_plan(_state(spark, sf), IN.page_limits(spark, sf))
    return r.select("page_slug", "id", "ordinal", "total", F.array_join("remaining", ",").alias("remaining"))


@query("sort_books")
def q_sort_books(spark, sf):
    p = IN.table(spark, sf, "part").select(F.col("p_partkey"), F.col("p_partkey").cast("string").alias("id"))
    r = ST.sort_books(p, keys=[])
    return r.select("p_partkey", TX.zfill_id("id").alias("zid"), "sort_rank")


@query("stage_transition")
def q_stage_transition(spark, sf):
    r = ST.stage_transition(_state(spark, sf), IN.stage_outcomes(spark, sf))
    return r.select("page_slug", "id", "status", "download_status", "ocr_status", "docx_conversion_status")


def _upserted(spark, sf) -> DataFrame:
    old = IN.prior_state(spark, sf).select(*STATE_COLUMNS)
    new = IN.catalogue_batch(spark, sf).drop("drop_year")
    return ST.state_upsert(old, new)


UPSERT_COLUMNS = ["page_slug", "id", "title_original", "pdf_url", "local_pdf_path", "local_md_path", "local_docx_path", "status", "download_status", "error_message"]


@query("state_upsert")
def q_state_upsert(spark, sf):
    return _upserted(spark, sf).select(*UPSERT_COLUMNS)


@query("new_books")
def q_new_books(spark, sf):
    old = IN.prior_state(spark, sf).select(*STATE_COLUMNS)
    new = IN.catalogue_batch(spark, sf)
    return ST.new_books(old, new).select("page_slug", "id", "pdf_url")


@query("incremental_upsert")
def q_incremental_upsert(spark, sf):
    from corpusflow.streaming.incremental import incremental_upsert_run

    return incremental_upsert_run(spark, sf).select(*UPSERT_COLUMNS)


# --- J1 / X2: handlers over pages ------------------------------------------------------------------------


@query("resolve_handler")
def q_resolve_handler(spark, sf):
    return _pages(spark, sf, "url").select("page_id", RS.match_handler("url", IN.HANDLERS).alias("handler"))


def _archive_resolver(url):
    ident = U.item_identifier(url, IN.LANG_SEGMENT)
    return F.when(ident.isNotNull(), F.concat(F.lit("https://"), U.url_authority(url), F.lit("/download/"), ident))


def _blog_resolver(url):
    return F.regexp_replace(url, "^http:", "https:")


REGISTRY = RS.HandlerRegistry().register_column("archive_handler", _archive_resolver).register_column("blog_handler", _blog_resolver)


@query("register_handler")
def q_register_handler(spark, sf):
    return REGISTRY.dispatch(_pages(spark, sf, "url"), "url", IN.HANDLERS).select("page_id", "handler", "resolved_url")


# --- J3 / X1 / X3 / R2 -------------------------------------------------------------------------------------


def _part_items(spark, sf) -> DataFrame:
    return IN.table(spark, sf, "part").select("p_partkey", "p_name", "p_brand")


@query("slug_cache_join")
def q_slug_cache_join(spark, sf):
    items = _part_items(spark, sf)
    cache = items.filter(F.col("p_name") < "n").select(
        "p_partkey",
        F.concat(F.lit("cached-"), TX.ascii_fold("p_name")).alias("title_english_slug"),
        F.when(F.col("p_partkey") % 3 == 0, F.lit("")).otherwise(F.concat(F.lit("cached-"), TX.ascii_fold("p_brand"))).alias("author_english_slug"),
    )
    r = EN.slug_cache_join(items, cache, "p_partkey", TX.ascii_fold("p_name"), TX.ascii_fold("p_brand"))
    return r.select("p_partkey", "title_english_slug", "author_english_slug", "from_cache")


@query("enrich_cached")
def q_enrich_cached(spark, sf):
    items = _part_items(spark, sf)
    return EN.enrich_cached(items, "p_name", provider=fold_provider).select("p_partkey", "slug")


def _job_results(spark, sf) -> DataFrame:
    ev = IN.table(spark, sf, "events").select("event_id", "ts", "user_id", "event_type")
    state = F.when(F.col("event_type") == "purchase", F.lit(EN.JOB_COMPLETED)).otherwise(F.col("event_type"))
    return ev.select("event_id", "ts", F.col("user_id").alias("doc_id"), state.alias("job_state"))


@query("ingest_ocr_results")
def q_ingest(spark, sf):
    per_doc, _ = EN.ingest_results(_job_results(spark, sf), "doc_id")
    return per_doc


@query("state_fold")
def q_state_fold(spark, sf):
    from corpusflow.streaming.fold import state_fold

    ev = IN.table(spark, sf, "events").select("event_id", "ts", "user_id", "event_type")
    return state_fold(ev, ["user_id"], "event_type", ["ts", "event_id"], out="last_status")


# --- K1 / S2 / K3 on driver data: written, then read back ------------------------------------------


@query("state_roundtrip")
def q_state_roundtrip(spark, sf):
    """K1 + S2: the orders-derived state written as a committed version, then loaded."""
    from corpusflow.session import scratch
    from corpusflow.sources import state as SS

    root = scratch(spark, "state")
    SS.save_state(_state(spark, sf), root)
    return SS.load_state(spark, root).select("page_slug", "id", "status", "download_status", "ocr_status", "docx_conversion_status", "pdf_url", "error_message")


@query("merged_text_sink")
def q_merged_text_sink(spark, sf):
    """K3: every conversation written as one markdown file (turns in order, each followed
    by the chunk separator), read back whole."""
    from corpusflow.session import scratch
    from corpusflow.sinks.text import write_merged

    out = scratch(spark, "merged")
    c = IN.table(spark, sf, "conversations").select("conv_id", "turn", "text")
    write_merged(c, "conv_id", "turn", "text", out)
    files = spark.read.text(out, wholetext=True)
    return files.select(F.col("conv_id").cast("bigint").alias("conv_id"), F.col("value").alias("merged_text"))


@query("ocr_output_unpack")
def q_ocr_output_unpack(spark, sf):
    """S6 + W4: per archive the first markdown entry (archive order) and the number of
    metadata JSON entries; archives without markdown have a null markdown (failed)."""
    entries = FS.unpack_archives(IN.ocr_archives(spark, sf))
    docs, meta = FS.ocr_outputs(entries)
    n_meta = meta.groupBy("archive_path").agg(F.count(F.lit(1)).cast("bigint").alias("n_metadata"))
    out = docs.join(n_meta, "archive_path", "left")
    return out.select(
        F.regexp_extract("archive_path", r"conv_(\d+)\.zip", 1).cast("bigint").alias("conv_id"),
        "markdown",
        "markdown_entry",
        F.coalesce(F.col("n_metadata"), F.lit(0).cast("bigint")).alias("n_metadata"),
    )


@query("ocr_document_outputs")
def q_ocr_document_outputs(spark, sf):
    """E2 over the per-conversation result archives (one unsplit chunk each): OCR success
    (markdown and metadata both present), the document's markdown, and its confidence
    metrics (A1) over the metadata blocks."""
    from corpusflow.plans.workflow import ocr_results

    archives = IN.ocr_archives(spark, sf).withColumn("path", F.regexp_replace("path", r"^conv_(\d+)\.zip$", "$1__0.zip"))
    plan = IN.table(spark, sf, "conversations").select(F.col("conv_id").cast("string").alias("doc")).distinct().withColumn("part", F.lit(None).cast("bigint"))
    r = ocr_results(spark, archives, plan)
    return r.select(
        F.col("doc").cast("bigint").alias("conv_id"),
        "ocr_ok",
        "n_chunks",
        "merged_text",
        F.round("avg_page_confidence", 6).alias("avg_page_confidence"),
        F.coalesce("low_confidence_blocks_count", F.lit(0).cast("bigint")).alias("low_confidence_blocks_count"),
        F.coalesce(F.array_join(F.col("pages_with_low_confidence_blocks").cast("array<string>"), ","), F.lit("")).alias("pages_with_low_confidence_blocks"),
    )


@query("reset_tool")
def q_reset_tool(spark, sf):
    """The reset tool over a written state — version 1 written, reset into version 2,
    version 2 read back."""
    from corpusflow.plans.workflow import reset
    from corpusflow.session import scratch
    from corpusflow.sources import state as SS

    root = scratch(spark, "reset")
    SS.save_state(_state(spark, sf), root)
    reset(spark, root)
    r = SS.load_state(spark, root)
    return r.select("page_slug", "id", "status", "download_status", "ocr_status", "docx_conversion_status", "error_message")


@query("full_run")
def q_full_run(spark, sf):
    """One pass of the full run from a config of all pages (one JSON document per line,
    each page's nav links as inline books) into an empty state; the new state version is
    read back. A book listed twice on a page: the later listing wins (D9)."""
    from corpusflow.plans.workflow import run_once
    from corpusflow.session import scratch
    from corpusflow.sources import state as SS

    root = scratch(spark, "run")
    IN.config_json(spark, sf, unique_names=True).select("config").write.text(f"{root}/config")
    run_once(spark, f"{root}/config", f"{root}/state", config_lines=True)
    r = SS.load_state(spark, f"{root}/state")
    return r.select("page_slug", "id", "title_original", "pdf_url", "local_pdf_path", "local_md_path", "local_docx_path", "status", "language")


# --- the operators on awkward inputs ------------------------------------------------------------


def _list_pages(spark, sf) -> DataFrame:
    """List pages in the catalogue's markup, one per page, from its nav links: nested spans, a
    stray end tag in every third item, every other item unclosed."""
    links = F.transform(
        IN.nav_links(),
        lambda x, k: F.concat(
            F.lit('<li id="li_id'), k.cast("string"), F.lit('"><span class="wrap"><span class="big titlespan"><a href="toc.php?book_id='),
            (F.col("page_id") * 100 + k).cast("string"), F.lit('">'), x["text"], F.lit("</a></span></span>"),
            F.when(k % 3 == 1, F.lit("</b>")).otherwise(F.lit("")),
            F.lit('<span class="authorspan"> — </span><span class="authorspan">'), U.url_authority("url"),
            F.lit('</span><span class="downloadpdf"><a href="'), x["href"], F.lit('">pdf</a></span>'),
            F.when(k % 2 == 0, F.lit("</li>")).otherwise(F.lit("")),
        ),
    )
    html = F.concat(F.lit('<html><div class="x books_from_db"><ul>'), F.array_join(links, "\n"), F.lit("</ul></div><p>end</p></html>"))
    return _pages(spark, sf, "url", "html").select("page_id", html.alias("html"))


@query("catalogue_dom_items")
def q_catalogue_dom_items(spark, sf):
    """S3 + S3b + S3c in DOM mode over nested, unclosed and stray markup."""
    it = SC.dom_items(_list_pages(spark, sf), "html")
    return it.select("page_id", F.col("item_pos").cast("bigint").alias("item_pos"), "title_original", "author_original", "title_href", "pdf_href", SC.catalogue_id("title_href", "pdf_href").alias("id"))


@query("catalogue_rejects")
def q_catalogue_rejects(spark, sf):
    """F4's rejects with their reason."""
    it = _items_with_id(spark, sf).withColumn("reason", SC.reject_reason())
    return it.filter(F.col("reason").isNotNull()).select("page_id", F.col("item_pos").cast("bigint").alias("item_pos"), "reason")


@query("job_rejects")
def q_job_rejects(spark, sf):
    """X3's rejected jobs with their reason."""
    _, rejects = EN.ingest_results(_job_results(spark, sf), "doc_id")
    return rejects.select("event_id", "doc_id", "reason")


@query("low_confidence_details")
def q_low_confidence_details(spark, sf):
    """A1's detail list: flat rows in file, part and block order of the document, with the text."""
    d = Q.low_confidence_details(_blocks(spark, sf), "doc_id")
    return d.select("doc_id", "detail_pos", "page_num", "block_id", "confidence", "text")


@query("resolved_urls_with_errors")
def q_resolved_urls_with_errors(spark, sf):
    """S4 -> W1 -> J5 through the registry, with metadata that wasn't fetched (item % 13 = 0) or
    is cut short (item % 11 = 0)."""
    k = F.col("item_id")
    cut = F.expr("substring(metadata, 1, length(metadata) - 2)")
    items = IN.listing_json(spark, sf).withColumn("metadata", F.when(k % 13 == 0, F.lit(None).cast("string")).when(k % 11 == 0, cut).otherwise(F.col("metadata")))
    items = items.withColumn("item_id", k.cast("string"))
    o = IN.table(spark, sf, "orders").select("o_orderkey")
    cat = o.select("o_orderkey", F.concat(F.lit(IN.ARCHIVE_HOST + "/details/"), F.col("o_orderkey").cast("string")).alias("url"))
    reg = RS.HandlerRegistry(default=RS.metadata_resolver(items, IN.DOWNLOAD_BASE))
    return reg.dispatch(cat, "url", [("archive.", "archive_handler")]).select("o_orderkey", "resolved_url")


@query("limit_shared_slug")
def q_limit_shared_slug(spark, sf):
    """W2 where two config pages share each slug: the first page's limit holds."""
    first = IN.page_limits(spark, sf)
    both = first.withColumn("page_pos", F.lit(0)).union(first.select("page_slug", F.lit(1).alias("limit"), F.lit(7).alias("page_pos")))
    return ST.limit_per_page(ST.pending_books(_state(spark, sf)), both, order=["page_pos"]).select("page_slug", "id", "ordinal")


@query("state_roundtrip_pages")
def q_state_roundtrip_pages(spark, sf):
    """K1 + S2 with hundreds of pages, one of them with an empty slug; then a re-scan of the same
    books, which must match every one of them."""
    from corpusflow.session import scratch
    from corpusflow.sources import state as SS

    root = scratch(spark, "state")
    wide = IN.book_state(spark, sf).withColumn("page_slug", F.when(F.col("o_orderkey") % 400 == 0, F.lit("")).otherwise(F.concat_ws("-", F.col("page_slug"), (F.col("o_orderkey") % 400).cast("string"))))
    SS.save_state(wide.select(*STATE_COLUMNS), root)
    again = SS.load_state(spark, root).select("page_slug", "id", F.concat("pdf_url", F.lit("?again")).alias("pdf_url"))
    return ST.state_upsert(SS.load_state(spark, root), again).select("page_slug", "id", "status", "pdf_url")


@query("incremental_order")
def q_incremental_order(spark, sf):
    """R1 with every key in two drops, the later one in a folder that sorts before the earlier."""
    from corpusflow.session import scratch
    from corpusflow.streaming.incremental import drain_drops, upsert_from_log

    root = scratch(spark, "drops")
    batch = IN.catalogue_batch(spark, sf).drop("drop_year")
    batch.withColumn("pdf_url", F.concat("pdf_url", F.lit("?old"))).write.parquet(f"{root}/drops/drop=9")
    batch.write.parquet(f"{root}/drops/drop=10")
    schema = spark.read.parquet(f"{root}/drops").schema
    drain_drops(spark, f"{root}/drops", schema, f"{root}/log", f"{root}/checkpoint")
    state = IN.prior_state(spark, sf).select(*STATE_COLUMNS)
    log = spark.read.parquet(f"{root}/log").drop("drop")
    return upsert_from_log(state, log, ["_arrival", "_source"]).select(*UPSERT_COLUMNS)


@query("enrich_cached_again")
def q_enrich_cached_again(spark, sf):
    """X1 called again with the cache that its first call left in the same folder."""
    from corpusflow.session import scratch

    items = _part_items(spark, sf)
    folder = scratch(spark, "enrich")
    EN.enrich_cached(items.filter(F.col("p_name") < "n"), "p_name", provider=fold_provider, cache_out=folder)
    cache = spark.read.parquet(folder).select("text", "slug")
    return EN.enrich_cached(items, "p_name", provider=fold_provider, cache=cache, cache_out=folder).select("p_partkey", "slug")


@query("ocr_damaged_archives")
def q_ocr_damaged_archives(spark, sf):
    """E2 where every fifth archive is cut short: its document fails, whatever could be read."""
    from corpusflow.plans.workflow import ocr_results

    a = IN.ocr_archives(spark, sf)
    conv = F.regexp_extract("path", r"^conv_(\d+)\.zip$", 1)
    cut = F.expr("substring(content, 1, length(content) - 30)")
    a = a.select(F.concat(conv, F.lit("__0.zip")).alias("path"), F.when(conv.cast("bigint") % 5 == 0, cut).otherwise(F.col("content")).alias("content"))
    plan = IN.table(spark, sf, "conversations").select(F.col("conv_id").cast("string").alias("doc")).distinct().withColumn("part", F.lit(None).cast("bigint"))
    return ocr_results(spark, a, plan).select(F.col("doc").cast("bigint").alias("conv_id"), "ocr_ok", "merged_text")


@query("binary_file_digest")
def q_binary_file_digest(spark, sf):
    """S5's scan over files: every conversation's merged markdown written, then digested."""
    from corpusflow.session import scratch
    from corpusflow.sinks.text import write_merged

    out = scratch(spark, "digests")
    write_merged(IN.table(spark, sf, "conversations").select("conv_id", "turn", "text"), "conv_id", "turn", "text", out)
    return FS.binary_digests(spark, out, "*.txt").select(F.regexp_extract("path", r"conv_id=(\d+)/", 1).cast("bigint").alias("conv_id"), "sha256")


# --- rows that were answered wrongly once ---------------------------------------------------------


@query("upsert_null_ids")
def q_upsert_null_ids(spark, sf):
    """J2 + M1 where one book a page has no id: a second pass over the same batch matches it again, and the
    stage outcomes reach it."""
    null_id = F.when(F.col("o_orderkey") == F.col("_least"), F.lit(None).cast("string")).otherwise(F.col("id"))
    st = IN.book_state(spark, sf)
    least = st.groupBy("page_slug").agg(F.min("o_orderkey").alias("_least"))
    st = st.join(least, "page_slug").withColumn("id", null_id)
    batch = st.select("page_slug", "id", "title_original", F.concat("pdf_url", F.lit("?scan")).alias("pdf_url"))
    empty = st.select(*STATE_COLUMNS).limit(0)
    twice = ST.state_upsert(ST.state_upsert(empty, batch), batch)
    outcomes = batch.where("id is null").select("page_slug", "id", *[F.lit(x).alias(c) for c, x in (("download_ok", True), ("ocr_ok", False), ("convert_ok", True), ("md_copied", True), ("docx_copied", True))])
    return ST.stage_transition(twice, outcomes).select("page_slug", "id", "pdf_url", "status", "download_status")


@query("resolved_urls_awkward_listings")
def q_resolved_urls_awkward_listings(spark, sf):
    """S4 -> W1 -> J5 where an item's listing is null (item % 7 = 0) or its first file's size has 20 digits
    (item % 5 = 0)."""
    k = F.col("item_id")
    huge = F.regexp_replace("metadata", r'^(\{"files":\[\{"name":"[^"]*")[^}]*\}', '$1,"size":"99999999999999999999"}')
    items = IN.listing_json(spark, sf).withColumn("metadata", F.when(k % 7 == 0, F.lit('{"files": null}')).when(k % 5 == 0, huge).otherwise(F.col("metadata")))
    items = items.withColumn("item_id", k.cast("string"))
    cat = IN.table(spark, sf, "orders").select("o_orderkey", F.concat(F.lit(IN.ARCHIVE_HOST + "/details/"), F.col("o_orderkey").cast("string")).alias("url"))
    reg = RS.HandlerRegistry(default=RS.metadata_resolver(items, IN.DOWNLOAD_BASE))
    return reg.dispatch(cat, "url", [("archive.", "archive_handler")]).select("o_orderkey", "resolved_url")


def _awkward_archives(spark, sf) -> tuple[DataFrame, DataFrame]:
    """(archives, plan): every third conversation's archive comes twice, every fifth is cut short."""
    a = IN.ocr_archives(spark, sf)
    conv = F.regexp_extract("path", r"^conv_(\d+)\.zip$", 1)
    cut = F.expr("substring(content, 1, length(content) - 30)")
    a = a.select(conv.alias("c"), F.when(conv.cast("bigint") % 5 == 0, cut).otherwise(F.col("content")).alias("content"))
    copies = F.when(F.col("c").cast("bigint") % 3 == 0, F.array(F.lit("dir1"), F.lit("dir2"))).otherwise(F.array(F.lit("dir2")))
    a = a.withColumn("dir", F.explode(copies)).select(F.concat("dir", F.lit("/"), "c", F.lit("__0.zip")).alias("path"), "content")
    plan = IN.table(spark, sf, "conversations").select(F.col("conv_id").cast("string").alias("doc")).distinct().withColumn("part", F.lit(None).cast("bigint"))
    return a, plan


@query("ocr_repeated_archives")
def q_ocr_repeated_archives(spark, sf):
    """E2 where a chunk's archive comes twice: its text counts once."""
    from corpusflow.plans.workflow import ocr_tables

    documents, _ = ocr_tables(spark, *_awkward_archives(spark, sf))
    return documents.select(F.col("doc").cast("bigint").alias("conv_id"), "ocr_ok", "n_chunks", "merged_text")


@query("ocr_rejects")
def q_ocr_rejects(spark, sf):
    """E2's rejects: damaged and repeated archives, archives without markdown, with the reason."""
    from corpusflow.plans.workflow import ocr_tables

    _, rejects = ocr_tables(spark, *_awkward_archives(spark, sf))
    return rejects.select("archive_path", F.regexp_replace("reason", "(?s): .*", "").alias("reason"))


# --- files: written one a row, digested by blocks, pre-checked --------------------------------------


def _own_name():
    return F.regexp_extract("path", r"(\d+)\.[a-z]+$", 1).cast("bigint")


@query("streamed_file_digest")
def q_streamed_file_digest(spark, sf):
    """S5 by block reads: every document's text as a file (but for every ninth, which isn't there), digested from the
    expected list."""
    from corpusflow.session import scratch
    from corpusflow.sources.filesystem import write_files

    root = scratch(spark, "texts")
    d = _docs(spark, sf, "text").select("doc_id", F.concat(F.lit(f"{root}/"), F.col("doc_id").cast("string"), F.lit(".txt")).alias("path"), F.col("text").alias("content"))
    write_files(d.where("doc_id % 9 <> 0"))
    expected = d.select("doc_id", "path", F.octet_length("content").cast("bigint").alias("length"))
    return FS.streamed_digests(expected).select(_own_name().alias("doc_id"), "sha256")


@query("precheck_files")
def q_precheck_files(spark, sf):
    """C4 on written files: good, cut, empty, without header, without pages, and not there."""
    from corpusflow.session import scratch
    from corpusflow.sources.filesystem import write_files

    root = scratch(spark, "pdfs")
    files = IN.pdf_files(spark, sf, root)
    write_files(files.where("content is not null"))
    found = FS.listed_files(spark, root, "*.pdf").select(_own_name().alias("doc_id"), "content")
    expected = IN.table(spark, sf, "documents").select("doc_id")
    return CH.precheck_expected(expected, CH.precheck_files(found), "doc_id").select("doc_id", "precheck_error", "page_count")


@query("placeholder_files")
def q_placeholder_files(spark, sf):
    """K4's two templates as files: the error of a document without quality label, else that OCR was disabled."""
    from corpusflow.session import scratch
    from corpusflow.sinks.text import write_placeholders

    root = scratch(spark, "placeholders")
    d = _docs(spark, sf).join(IN.table(spark, sf, "labels").select("doc_id", "quality"), "doc_id", "left")
    name = F.concat(F.col("doc_id").cast("string"), F.lit(".pdf"))
    failed = CH.failed_placeholder(name, F.lit(CH.MSG_NOT_FOUND))
    text = F.when(F.col("quality").isNull(), failed).otherwise(CH.skipped_placeholder(name, "hosted"))
    write_placeholders(d.select(IN.spread_path(root, ".md").alias("path"), text.alias("text")), "path", "text")
    files = FS.listed_files(spark, root, "*.md")
    return files.select(_own_name().alias("doc_id"), F.decode("content", "UTF-8").alias("placeholder"))


# --- streams ----------------------------------------------------------------------------------------


@query("incremental_batches")
def q_incremental_batches(spark, sf):
    """R1 by micro-batches with a ledger: every key comes in an old and in a new drop, drained one after the
    other; then the first drain's batch is replayed, which changes nothing."""
    from corpusflow.session import scratch
    from corpusflow.sources import state as SS
    from corpusflow.streaming import incremental as INC

    root = scratch(spark, "batches")
    SS.save_state(IN.prior_state(spark, sf), f"{root}/state")
    batch = IN.catalogue_batch(spark, sf).drop("drop_year")
    old = batch.withColumn("pdf_url", F.concat("pdf_url", F.lit("?old")))
    for name, drop in (("9", old), ("10", batch)):
        drop.write.parquet(f"{root}/drops/drop={name}")
        INC.apply_drops(spark, f"{root}/drops", batch.schema, f"{root}/state", f"{root}/checkpoint")
    (stream, _), = SS.load_ledger(spark, f"{root}/state").items()
    again = old.withColumn("_arrival", F.current_timestamp()).withColumn("_source", F.lit(""))
    if INC.apply_batch(again, 0, f"{root}/state", stream) is not None:
        raise RuntimeError("a replayed batch was folded again")
    return SS.load_state(spark, f"{root}/state").select(*UPSERT_COLUMNS)


@query("streaming_state_fold")
def q_streaming_state_fold(spark, sf):
    """R2 on a stream: events in four drops that aren't in order of time, one micro-batch each, through the keyed state;
    the last change of each key is the batch fold's result."""
    from corpusflow.session import scratch
    from corpusflow.streaming.fold import drain_keyed_fold, state_fold

    root = scratch(spark, "fold")
    ev = IN.table(spark, sf, "events").select("event_id", "ts", "user_id", "event_type")
    ev.repartition(4, F.xxhash64("event_id") % 4).write.parquet(f"{root}/drops")
    stream = spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/drops")
    drain_keyed_fold(stream, ["user_id"], "event_type", ["ts", "event_id"], f"{root}/log", f"{root}/checkpoint")
    return state_fold(spark.read.parquet(f"{root}/log"), ["user_id"], "event_type", ["ts", "event_id"], out="last_status")


# --- handlers: long lists, modules by name -------------------------------------------------------


@query("resolve_handler_many")
def q_resolve_handler_many(spark, sf):
    """J1 with a handler for every part (pattern ``<key>.``, config order by key) over a URL for each order."""
    keys = [r["p_partkey"] for r in IN.table(spark, sf, "part").select("p_partkey").orderBy("p_partkey").collect()]  # the config
    handlers = [(f"{k}.", f"module_{k}") for k in keys]
    o = IN.table(spark, sf, "orders").select("o_orderkey", F.concat(F.lit("https://www.c"), F.col("o_custkey").cast("string"), F.lit(".shelf.test/x")).alias("url"))
    return o.select("o_orderkey", RS.match_handler_many(spark, "url", handlers).alias("handler"))


@query("resolve_by_module")
def q_resolve_by_module(spark, sf):
    """X2 by module name over the pages: modules that answer, answer nothing, raise, have no function, aren't there."""
    base = "corpusflow.plans.handlers."
    module = F.element_at(F.array(*[F.lit(base + m) for m in ("secure", "raising", "silent", "absent")], F.lit(None).cast("string")), (F.col("page_id") % 5 + 1).cast("int"))
    return RS.resolve_by_module(_pages(spark, sf, "url").withColumn("handler", module), "url").select("page_id", "resolved_url", "resolve_error")


# --- the full run with a prior state, outcomes, list pages and rejects ------------------------------


def _run_inputs(spark, sf, root) -> DataFrame:
    """Writes the config: all pages as JSON Lines; every third page has a URL instead of its books (its list page is
    returned, but for every ninth page, whose list wasn't fetched), every eleventh book has no id."""
    pages = IN.config_json(spark, sf, unique_names=True)
    url = F.concat(F.lit("https://books.example.org/list_"), F.col("page_id").cast("string"), F.lit(".php"))
    listed = F.concat(F.lit('[{"url":"'), url, F.lit('",'), F.substring("config", 3, 1 << 30))
    unnamed = F.regexp_replace("config", r'"id":"[^"]*7",', "")
    pages.select(F.when(F.col("page_id") % 3 == 0, listed).otherwise(unnamed).alias("value")).write.text(f"{root}/config")
    lists = _list_pages(spark, sf).where("page_id % 3 = 0 and page_id % 9 <> 0")
    return lists.select(url.alias("page_url"), "html")


def _outcomes(state: DataFrame) -> DataFrame:
    n = F.length("id")
    return state.select("page_slug", "id", (n % 2 == 0).alias("download_ok"), (n % 3 != 0).alias("ocr_ok"), F.lit(True).alias("convert_ok"), F.lit(True).alias("md_copied"), (n % 5 != 0).alias("docx_copied"))


@query("full_run_outcomes")
def q_full_run_outcomes(spark, sf):
    """E1 twice: the first pass fills the state from inline books and list pages; the second starts from that state
    and applies the stage outcomes to the rows of its plan."""
    from corpusflow.plans.workflow import run_once
    from corpusflow.session import scratch
    from corpusflow.sources import state as SS

    root = scratch(spark, "run")
    lists = _run_inputs(spark, sf, root)
    run_once(spark, f"{root}/config", f"{root}/state", list_pages=lists, config_lines=True)
    run_once(spark, f"{root}/config", f"{root}/state", outcomes=_outcomes(SS.load_state(spark, f"{root}/state")), list_pages=lists, config_lines=True)
    return SS.load_state(spark, f"{root}/state").select("page_slug", "id", "title_original", "status", "download_status", "ocr_status", "docx_conversion_status")


@query("full_run_rejects")
def q_full_run_rejects(spark, sf):
    """E1's rejects: books without id, listings that a later one replaced, lists that weren't fetched, with the reason."""
    from corpusflow.plans.workflow import run_once, run_table
    from corpusflow.session import scratch

    root = scratch(spark, "run")
    run_once(spark, f"{root}/config", f"{root}/state", list_pages=_run_inputs(spark, sf, root), config_lines=True)
    return run_table(spark, f"{root}/state", "rejects").select("page_slug", "id", F.col("item_pos").cast("bigint").alias("item_pos"), "reason")


# --- state by touched pages, texts in containers ------------------------------------------------------


@query("state_touched_pages")
def q_state_touched_pages(spark, sf):
    """K1 + J2 by page buckets: hundreds of pages are stored, four re-scanned; only their buckets are written again."""
    from corpusflow.session import scratch
    from corpusflow.sources import buckets as SB

    root = scratch(spark, "buckets")
    wide = IN.book_state(spark, sf).withColumn("page_slug", F.concat_ws("-", F.lit("page"), (F.col("o_orderkey") % 400).cast("string")))
    SB.save_buckets(wide, root)
    again = wide.where(F.col("o_orderkey") % 400 < 4).select("page_slug", "id", F.concat("pdf_url", F.lit("?again")).alias("pdf_url"))
    SB.upsert_pages(spark, root, again)
    return SB.load_buckets(spark, root).select("page_slug", "id", "status", "pdf_url")


@query("packed_text_sink")
def q_packed_text_sink(spark, sf):
    """K3 as a container: every conversation's merged text in a few files with an index, read back whole."""
    from corpusflow.session import scratch
    from corpusflow.sinks.container import read_container, write_container

    out = scratch(spark, "container")
    write_container(IN.table(spark, sf, "conversations").select("conv_id", "turn", "text"), "conv_id", "turn", "text", out)
    return read_container(spark, out).select(F.col("doc").cast("bigint").alias("conv_id"), "n_parts", "merged_text")
