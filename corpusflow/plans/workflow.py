"""The reference's full run and reset, composed from the operators.

A run is a handful of DataFrames, each written once; what lasts are the new state version, its plan and
rejects, and the enrichment cache when a provider is used:

    config -> enabled pages -> inline books (J1/X2 resolve, P6 paths)
                            -> list pages (S3 DOM items, S3c ids, F4, J3/X1 slugs, P6b)
           -> J2 upsert into state -> M3 resume plan (F2, W2, W3, F7)
           -> M1 stage transition for the planned rows -> K1 new state version
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from corpusflow.functions.text import slugify
from corpusflow.functions.urls import url_join
from corpusflow.operators import catalogue as CAT
from corpusflow.operators import enrich as EN
from corpusflow.operators import state as ST
from corpusflow.operators.resolve import HandlerRegistry, match_handler_col, resolve_by_module
from corpusflow.schemas import BOOK_STATE, STATE_COLUMNS
from corpusflow.session import scratch
from corpusflow.sources import catalogue as SC
from corpusflow.sources import config as CFG
from corpusflow.sources import state as SS


def inline_catalogue(pages: DataFrame, registry: HandlerRegistry | None, modules: bool = False) -> DataFrame:
    """State rows for inline books of enabled pages without a URL (URL resolution first, by the
    handlers of the page's own config: a registry's resolvers, or with ``modules`` the Python modules that
    the config names). ``_reason`` says why a row can't be kept (null: it can)."""
    books = CFG.inline_books(pages.filter(F.col("page_url").isNull()))
    if registry is not None:
        books = registry.dispatch(books, "pdf_url", "handlers").withColumn("pdf_url", F.col("resolved_url")).drop("resolved_url", "handler")
    elif modules:
        books = resolve_by_module(books.withColumn("handler", match_handler_col("pdf_url", "handlers")), "pdf_url")
        books = books.withColumn("pdf_url", F.col("resolved_url")).drop("resolved_url", "resolve_error", "handler")
    rows = CAT.inline_book_rows(books, "title_slug_in", "author_slug_in")
    # The book's own language when given, else the page's (OCR keeps the page language)
    lang = F.coalesce(F.col("book_language"), F.col("page_language"))
    return (
        rows.withColumn("language", lang)
        .withColumn("_seq", F.struct("config_path", "page_pos", F.col("book_pos").alias("item_pos")))
        .withColumn("_reason", F.when(F.col("id").isNull(), F.lit("book has no id")))
    )


def _cache(spark: SparkSession, folder: str | None) -> DataFrame | None:
    """The answers that earlier runs left in ``folder``; None where there are none yet."""
    if folder is None or not SS.exists(spark, folder):
        return None
    return spark.read.schema("text string, slug string").option("recursiveFileLookup", "true").parquet(folder)


def scraped_catalogue(
    pages: DataFrame,
    list_pages: DataFrame,
    state: DataFrame | None = None,
    enrich_languages: set[str] | None = None,
    provider=None,
    cache_dir: str | None = None,
) -> DataFrame:
    """State rows for enabled pages with a URL, from their fetched HTML (``page_url, html``).

    D1: pages whose language prefix (``kn`` of ``kn-IN``) is in ``enrich_languages`` get
    their slugs from the cached provider (X1), reusing both slugs of an existing state row
    when both are non-empty (J3) and the answers in ``cache_dir``, where new ones are kept for later runs; every
    other page slugifies title and author directly. Incomplete items (F4) and pages whose list wasn't
    fetched come with a ``_reason``."""
    spark = pages.sparkSession
    listed = pages.filter(F.col("page_url").isNotNull())
    with_html = listed.join(list_pages, "page_url")
    items = SC.dom_items(with_html.select("config_path", "page_pos", "page_slug", "page_url", "page_language", "html"), "html")
    items = items.withColumn("id", SC.catalogue_id("title_href", "pdf_href")).withColumn("_reason", SC.reject_reason())
    ok = items.filter(F.col("_reason").isNull()).withColumn("author_original", F.coalesce("author_original", F.lit("")))
    langs = sorted(enrich_languages or [])
    prefix = F.substring_index(F.col("page_language"), "-", 1)
    enrich = prefix.isin(langs) if langs else F.lit(False)
    plain = ok.filter(~enrich)
    rows = CAT.scraped_book_rows(plain, slugify("title_original"), slugify("author_original"))
    if langs:
        todo = ok.filter(enrich)
        if state is not None:
            cache = state.select("page_slug", "id", "title_english_slug", "author_english_slug")
            todo = todo.join(cache, ["page_slug", "id"], "left")
            use = (F.coalesce("title_english_slug", F.lit("")) != "") & (F.coalesce("author_english_slug", F.lit("")) != "")
        else:
            todo = todo.withColumn("title_english_slug", F.lit(None).cast("string")).withColumn("author_english_slug", F.lit(None).cast("string"))
            use = F.lit(False)
        cached = todo.filter(use)
        fresh = todo.filter(~use).drop("title_english_slug", "author_english_slug")
        for column, out in (("title_original", "_t"), ("author_original", "_a")):
            fresh = EN.enrich_cached(fresh, column, provider=provider, cache=_cache(spark, cache_dir), cache_out=cache_dir).withColumnRenamed("slug", out)
        rows = rows.unionByName(CAT.scraped_book_rows(fresh, F.col("_t"), F.col("_a")).drop("_t", "_a"))
        rows = rows.unionByName(CAT.scraped_book_rows(cached, F.col("title_english_slug"), F.col("author_english_slug")))
    rows = (
        rows.withColumn("pdf_url", url_join("page_url", "pdf_href"))
        .withColumn("language", F.col("page_language"))
        .withColumn("_seq", F.struct("config_path", "page_pos", "item_pos"))
    )
    place = F.struct("config_path", "page_pos", "item_pos").alias("_seq")
    incomplete = items.filter(F.col("_reason").isNotNull()).select("page_slug", F.nullif("id", F.lit("")).alias("id"), "title_original", place, "_reason")
    unfetched = listed.join(list_pages.select("page_url"), "page_url", "left_anti").withColumn("item_pos", F.lit(None).cast("int"))
    unfetched = unfetched.select("page_slug", place, F.lit("list page wasn't fetched").alias("_reason"))
    return rows.unionByName(incomplete, allowMissingColumns=True).unionByName(unfetched, allowMissingColumns=True)


def run_once(
    spark: SparkSession,
    config_path: str,
    state_root: str,
    outcomes: DataFrame | None = None,
    list_pages: DataFrame | None = None,
    registry: HandlerRegistry | None = None,
    enrich_languages: set[str] | None = None,
    provider=None,
    config_lines: bool = False,
    modules: bool = False,
    cache_dir: str | None = None,
) -> dict:
    """One pass of the pipeline. Beside the new state version (``v=<n>``) it leaves the rows that were
    to be processed (``_plan/v=<n>``) and those that couldn't be kept, with the reason (``_rejects/v=<n>``); a read of either
    goes by committed versions. Returns the version and the counts, which are observed while these tables are
    written."""
    cfg = CFG.read_config(spark, config_path, lines=config_lines)
    pages = CFG.enabled_pages(CFG.config_pages(cfg, keep=["config_path", "handlers"]))
    state = SS.load_state(spark, state_root)
    parts = [inline_catalogue(pages, registry, modules)]
    if list_pages is not None:
        parts.append(scraped_catalogue(pages, list_pages, state, enrich_languages, provider, cache_dir))
    catalogue = parts[0]
    for p in parts[1:]:
        catalogue = catalogue.unionByName(p, allowMissingColumns=True)
    cols = [c for c in STATE_COLUMNS if c in catalogue.columns]
    # parsed and resolved once: the merge, the plan and the rejects all read it
    path = scratch(spark, "catalogue")
    catalogue.select(*cols, "_seq", "_reason").write.parquet(path)
    catalogue = spark.read.parquet(path)
    # An id listed twice in one pass -> the later listing wins, the rest are rejects
    kept = catalogue.filter(F.col("_reason").isNull()).drop("_reason")
    batch, earlier = ST.dedupe_batch(kept, ST.KEYS, "_seq")
    why = earlier.withColumn("_reason", F.lit("listed again later"))
    rejects = catalogue.filter(F.col("_reason").isNotNull()).unionByName(why)
    path = scratch(spark, "merged")
    ST.state_upsert(state, batch.select(*cols)).write.parquet(path)
    merged = spark.read.schema(BOOK_STATE).parquet(path)
    version = SS.next_version(spark, state_root)
    seen, planned = Observation(), Observation()
    rejects = rejects.select("page_slug", "id", "title_original", "pdf_url", F.col("_seq.config_path").alias("config_path"), F.col("_seq.page_pos").alias("page_pos"), F.col("_seq.item_pos").alias("item_pos"), F.col("_reason").alias("reason"))
    rejects.observe(seen, F.count(F.lit(1)).alias("n")).write.parquet(f"{state_root}/_rejects/v={version}")
    limits = pages.select("page_slug", "config_path", "page_pos", F.col("page_limit").alias("limit"))
    plan = ST.resume_plan(merged, limits, order=["config_path", "page_pos"]).select("page_slug", "id", "ordinal", "total", "remaining")
    plan.observe(planned, F.count(F.lit(1)).alias("n")).write.parquet(f"{state_root}/_plan/v={version}")
    if outcomes is not None:
        todo = spark.read.schema(plan.schema).parquet(f"{state_root}/_plan/v={version}")
        merged = ST.stage_transition(merged, outcomes.join(todo, ST.same_keys(outcomes, todo, ST.KEYS), "left_semi"))
    SS.save_state(merged, state_root, version)
    return {"version": version, "planned": planned.get["n"], "rejected": seen.get["n"]}


def run_table(spark: SparkSession, state_root: str, name: str) -> DataFrame:
    """What the last committed run left beside its state: ``plan`` or ``rejects``."""
    version = SS.committed_versions(spark, state_root)[-1]
    return spark.read.parquet(f"{state_root}/_{name}/v={version}")


def reset(spark: SparkSession, state_root: str, target_page: str | None = None) -> dict:
    """Reset failed / in-progress rows (optionally one page) into a new version; returns it
    and the number of rows reset (``state.reset_counts`` has them by page, as a DataFrame)."""
    state = SS.load_state(spark, state_root)
    total = ST.reset_counts(state, target_page).agg(F.coalesce(F.sum("n_reset"), F.lit(0)).alias("n")).first()["n"]
    version = SS.save_state(ST.reset_statuses(state, target_page), state_root)
    return {"version": version, "reset": total}


# --- E2: OCR results -> documents ------------------------------------------------------

# fixed value: result archives are named ``<doc>__<part>.zip`` (part 0 = whole document)
ARCHIVE_NAME = r"([^/]+)__(\d+)\.zip$"


def ocr_tables(spark: SparkSession, archives, plan: DataFrame) -> tuple[DataFrame, DataFrame]:
    """E2 after the external OCR jobs: (documents, rejects).

    Documents, one row for each of ``plan`` (doc, part; part 0 or null: a whole document): whether OCR succeeded (every
    chunk's archive gave its markdown and no page metadata of the document is malformed), the merged markdown, and
    the confidence metrics over all chunks' page metadata (an archive without metadata entries succeeds; no block, no
    average). Rejects are ``archive_path, file_name, reason``: unreadable archives, archives without markdown, archives
    of a (doc, part) that another archive with a smaller path also has, and malformed pages.

    S6 unpack -> J6 chunk outputs -> A2 all-or-nothing -> A3 ordered merge; S7 blocks -> U2 (keyed by doc, part,
    page) -> A1 metrics. Archives are unpacked once, into a written table that all later steps read."""
    from corpusflow.operators import chunks as CH
    from corpusflow.operators import quality as Q
    from corpusflow.sources import files as FS

    # archives: a folder of result archives, or a DataFrame in the binaryFile layout
    raw = FS.archive_entries(spark, archives) if isinstance(archives, str) else FS.unpack_archives(archives)
    path = scratch(spark, "ocr-entries")
    raw.write.parquet(path)
    raw = spark.read.schema(raw.schema).parquet(path)
    key = lambda c: F.regexp_extract(F.col("archive_path"), ARCHIVE_NAME, c)
    raw = raw.withColumn("doc", key(1)).withColumn("part", key(2).cast("bigint"))
    firsts = raw.groupBy("doc", "part").agg(F.min("archive_path").alias("_first"))
    raw = raw.join(firsts, ["doc", "part"]).withColumn("_again", F.col("archive_path") != F.col("_first")).drop("_first")
    entries = raw.filter(F.col("error").isNull() & ~F.col("_again"))
    docs, meta = FS.ocr_outputs(entries)
    docs = docs.withColumn("doc", key(1)).withColumn("part", key(2).cast("bigint"))
    meta = meta.withColumn("doc", key(1)).withColumn("part", key(2).cast("bigint"))
    bad = FS.block_rejects(meta, "content", "file_name", ["archive_path", "doc"])
    chunks = plan.select("doc", F.coalesce(F.col("part").cast("bigint"), F.lit(0).cast("bigint")).alias("part")).distinct()
    texts = docs.filter(F.col("markdown").isNotNull())
    # an archive that could be read has its metadata folder, be it empty
    outputs = CH.chunk_outputs(chunks, texts.select("doc", "part"), docs.select("doc", "part"), ["doc", "part"])
    broken = bad.select("doc").distinct().withColumn("_bad", F.lit(True))
    success = CH.document_success(outputs, "doc").join(broken, "doc", "left").withColumn("success", F.col("success") & F.col("_bad").isNull()).drop("_bad")
    good = success.filter("success").select("doc")
    # a document that was not split keeps its markdown as is; chunks get the separator
    pieces = texts.withColumn(
        "piece", F.when(F.col("part") == 0, F.col("markdown")).otherwise(F.concat(F.col("markdown"), F.lit(CH.CHUNK_SEPARATOR)))
    )
    planned = chunks.join(good, "doc", "left_semi")
    merged = CH.ordered_merge(pieces.join(planned, ["doc", "part"], "left_semi"), "doc", "part", "piece", sep="")
    blocks = FS.block_rows(
        meta.join(planned, ["doc", "part"], "left_semi").withColumnRenamed("content", "metadata"), "metadata", "file_name", ["doc", "part"]
    )
    metrics = Q.confidence_metrics(blocks, good, "doc")
    documents = (
        success.select("doc", F.col("success").alias("ocr_ok"), "n_chunks")
        .join(merged.select("doc", "merged_text"), "doc", "left")
        .join(metrics, "doc", "left")
    )
    none = F.lit(None).cast("string")
    reason = F.when(F.col("_again"), F.lit("another archive of this chunk was taken")).otherwise(F.concat(F.lit("archive is damaged: "), F.col("error")))
    lost = raw.where(F.col("error").isNotNull() | F.col("_again")).select("archive_path", none.alias("file_name"), reason.alias("reason")).distinct()
    textless = docs.where(F.col("markdown").isNull()).select("archive_path", none.alias("file_name"), F.lit("archive has no markdown").alias("reason"))
    rejects = lost.unionByName(textless).unionByName(bad.select("archive_path", "file_name", "reason"))
    return documents, rejects


def ocr_results(spark: SparkSession, archives, plan: DataFrame) -> DataFrame:
    """The documents of :func:`ocr_tables`."""
    return ocr_tables(spark, archives, plan)[0]
