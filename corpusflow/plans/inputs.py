"""Operator inputs derived by Spark from the driver tables (the bindings of FIXTURES.md §3,
re-aimed so every query reads whole tables and whole texts).

Each function takes ``(spark, sf_dir)`` and returns a DataFrame; scans select only the
columns they need so Parquet column pruning applies.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusflow.functions.html import unescape
from corpusflow.functions.text import slugify
from corpusflow.operators.ranking import ensure_parallelism

# --- fixed values of the bindings -----------------------------------------------------------
NAV_LINK = r'<li><a href="([^"]*)">([^<]*)</a></li>'
ARCHIVE_HOST = "https://archive.example.org"
MIRROR_HOST = "https://mirror.example.org"
DOWNLOAD_BASE = ARCHIVE_HOST + "/download"
LANG_SEGMENT = "[a-z]{2}"
HANDLERS = [("blog.", "blog_handler"), ("example.com", "archive_handler"), ("www.", "www_handler")]
# ---------------------------------------------------------------------------------------------


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- lineitem -> file listings and page metadata ---------------------------------------------

_LINE_ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_shipdate"]


def listing_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One metadata document per item (= order): ``{"files": [{name, size}, ...]}`` in
    line order. Name ``{partkey}`` + ``_text.pdf`` (R) / ``.pdf`` (A, ``.PDF`` when F) /
    ``.txt`` (N); size = quantity, missing when discount is 0, 'abc' when tax is 0.08 on an
    open line."""
    li = table(spark, sf_dir, "lineitem").select(*_LINE_ORDER, "l_orderkey", "l_returnflag", "l_linestatus", "l_discount", "l_tax")
    suffix = (
        F.when(F.col("l_returnflag") == "R", F.lit("_text.pdf"))
        .when((F.col("l_returnflag") == "A") & (F.col("l_linestatus") == "F"), F.lit(".PDF"))
        .when(F.col("l_returnflag") == "A", F.lit(".pdf"))
        .otherwise(F.lit(".txt"))
    )
    name = F.concat(F.col("l_partkey").cast("string"), suffix)
    size = (
        F.when(F.col("l_discount") == 0, F.lit(None).cast("string"))
        .when((F.col("l_tax") == 0.08) & (F.col("l_linestatus") == "O"), F.lit("abc"))
        .otherwise(F.col("l_quantity").cast("int").cast("string"))
    )
    rows = li.select(F.col("l_orderkey").alias("item_id"), F.struct(*_LINE_ORDER, name.alias("name"), size.alias("size")).alias("_e"))
    rows = ensure_parallelism(rows, by=["item_id"])
    g = rows.groupBy("item_id").agg(F.array_sort(F.collect_list("_e")).alias("_f"))
    return g.select("item_id", F.to_json(F.struct(F.transform("_f", lambda x: F.struct(x["name"].alias("name"), x["size"].alias("size"))).alias("files"))).alias("metadata"))


def metadata_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One page-metadata JSON per (doc, part, page): doc = order, part = suppkey % 3,
    page = line number; one block per line (confidence = quantity / 50, key absent for
    return flag N). ``page_num`` is absent for pages above 4, so it comes from the file
    name ``page_{n}.json``."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_shipdate", "l_returnflag", "l_linestatus"
    )
    block = F.struct(
        F.col("l_partkey"),
        F.col("l_suppkey"),
        F.col("l_quantity"),
        F.col("l_shipdate"),
        F.concat(F.lit("b"), F.col("l_partkey").cast("string"), F.lit("_"), F.col("l_suppkey").cast("string")).alias("block_id"),
        F.when(F.col("l_returnflag") != "N", F.col("l_quantity") / 50).alias("confidence"),
        F.concat(F.col("l_returnflag"), F.col("l_linestatus")).alias("text"),
    )
    rows = li.select(
        F.col("l_orderkey").alias("doc_id"),
        (F.col("l_suppkey") % 3).cast("int").alias("part"),
        F.col("l_linenumber").alias("page"),
        block.alias("_e"),
    )
    rows = ensure_parallelism(rows, by=["doc_id", "part", "page"])
    g = rows.groupBy("doc_id", "part", "page").agg(F.array_sort(F.collect_list("_e")).alias("_b"))
    blocks = F.transform("_b", lambda b: F.struct(b["block_id"].alias("block_id"), b["confidence"].alias("confidence"), b["text"].alias("text")))
    doc = F.struct(F.when(F.col("page") <= 4, F.col("page")).alias("page_num"), blocks.alias("blocks"))
    return g.select(
        "doc_id", "part", F.concat(F.lit("page_"), F.col("page").cast("string"), F.lit(".json")).alias("file_name"), F.to_json(doc).alias("metadata")
    )


# --- pages -> config and catalogue ------------------------------------------------------------


def nav_links(html_col: str = "html"):
    return F.arrays_zip(
        F.regexp_extract_all(F.col(html_col), F.lit(NAV_LINK), 1).alias("href"),
        F.regexp_extract_all(F.col(html_col), F.lit(NAV_LINK), 2).alias("text"),
    )


def config_json(spark: SparkSession, sf_dir: str, unique_names: bool = False) -> DataFrame:
    """One config document per page (legacy list layout: ``[page]``): name = h1, no url,
    language = ``<html lang>``, enabled unless German, no limit for English else 3,
    inline books = the nav links (id = href without '/', title = link text)."""
    from corpusflow.functions.html import html_lang, tag_text

    p = table(spark, sf_dir, "pages").select("page_id", "html")
    books = F.transform(
        nav_links(),
        lambda x: F.struct(
            F.substring(x["href"], 2, 1 << 30).alias("id"),
            unescape(x["text"]).alias("title_original"),
            x["href"].alias("pdf_url"),
        ),
    )
    lang = F.nullif(html_lang("html"), F.lit(""))
    name = F.nullif(tag_text("html", "h1"), F.lit(""))
    if unique_names:  # '<h1> page <id>': one page slug per page
        name = F.concat_ws(" ", name, F.lit("page"), F.col("page_id").cast("string"))
    page = F.struct(
        name.alias("name"),
        lang.alias("language"),
        (F.coalesce(lang, F.lit("")) != "de").alias("process_flag"),
        F.when(lang != "en", F.lit(3)).alias("limit"),
        books.alias("books"),
    )
    return p.select("page_id", F.to_json(F.array(page)).alias("config"))


# --- orders -> book state ----------------------------------------------------------------------


def book_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """State rows from orders: page = slug of the priority, id = order key; status
    F -> completed, P -> in_progress, O -> failed; stage statuses from the customer key
    (download: %2 completed/absent; ocr: %3 completed/pending/absent; docx: %5
    completed, completed, pending, failed, absent)."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    return o.select(
        slugify("o_orderpriority").alias("page_slug"),
        F.col("o_orderkey").cast("string").alias("id"),
        F.concat(F.lit("Order "), F.col("o_orderkey").cast("string")).alias("title_original"),
        F.lit("").alias("author_original"),
        F.lit(None).cast("string").alias("title_english_slug"),
        F.lit(None).cast("string").alias("author_english_slug"),
        F.lit("en-IN").alias("language"),
        F.concat(F.lit(ARCHIVE_HOST + "/details/"), F.col("o_orderkey").cast("string")).alias("pdf_url"),
        F.concat(F.lit("old/"), F.col("o_orderkey").cast("string"), F.lit(".pdf")).alias("local_pdf_path"),
        F.concat(F.lit("old/"), F.col("o_orderkey").cast("string"), F.lit(".md")).alias("local_md_path"),
        F.concat(F.lit("old/"), F.col("o_orderkey").cast("string"), F.lit(".docx")).alias("local_docx_path"),
        F.when(F.col("o_orderstatus") == "F", "completed").when(F.col("o_orderstatus") == "P", "in_progress").otherwise("failed").alias("status"),
        F.lit(None).cast("string").alias("pdf_sha256_hash"),
        F.when(F.col("o_custkey") % 2 == 0, "completed").alias("download_status"),
        F.when(F.col("o_custkey") % 3 == 0, "completed").when(F.col("o_custkey") % 3 == 1, "pending").alias("ocr_status"),
        F.when(F.col("o_custkey") % 5 <= 1, "completed").when(F.col("o_custkey") % 5 == 2, "pending").when(F.col("o_custkey") % 5 == 3, "failed").alias("docx_conversion_status"),
        F.when(F.col("o_orderstatus") == "O", F.lit("stage error")).alias("error_message"),
        F.col("o_orderstatus"),
        F.col("o_orderkey"),
    )


def page_limits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per page (priority) limit: urgent 100, high none, medium 0 (= none), not specified
    250, low 2."""
    o = table(spark, sf_dir, "orders").select("o_orderpriority").distinct()
    lim = (
        F.when(F.col("o_orderpriority") == "1-URGENT", 100)
        .when(F.col("o_orderpriority") == "3-MEDIUM", 0)
        .when(F.col("o_orderpriority") == "4-NOT SPECIFIED", 250)
        .when(F.col("o_orderpriority") == "5-LOW", 2)
    )
    return o.select(slugify("o_orderpriority").alias("page_slug"), lim.cast("int").alias("limit"))


def stage_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    k = F.col("o_orderkey")
    return o.select(
        slugify("o_orderpriority").alias("page_slug"),
        k.cast("string").alias("id"),
        (k % 2 != 0).alias("download_ok"),
        (k % 3 != 0).alias("ocr_ok"),
        (k % 5 != 0).alias("convert_ok"),
        (k % 7 != 0).alias("md_copied"),
        (k % 11 != 0).alias("docx_copied"),
    )


def catalogue_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A re-scan of the catalogue: orders that are open or pending (status O, P), with a
    new URL carrying the price and new paths; status 'pending'."""
    st = book_state(spark, sf_dir).filter(F.col("o_orderstatus").isin("O", "P"))
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderdate")
    j = st.join(o, "o_orderkey")
    cents = F.round(F.col("o_totalprice") * 100).cast("bigint").cast("string")
    base = F.concat_ws("/", F.col("page_slug"), F.col("id"))
    return j.select(
        "page_slug",
        "id",
        "title_original",
        "author_original",
        "language",
        F.concat(F.lit(MIRROR_HOST + "/"), F.col("id"), F.lit("/"), cents, F.lit(".pdf")).alias("pdf_url"),
        F.concat(F.lit("raw_pdf/"), base, F.lit(".pdf")).alias("local_pdf_path"),
        F.concat(F.lit("processed_docs/"), base, F.lit(".md")).alias("local_md_path"),
        F.concat(F.lit("processed_docs/"), base, F.lit(".docx")).alias("local_docx_path"),
        F.lit("pending").alias("status"),
        F.year("o_orderdate").alias("drop_year"),
    )


def prior_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """State before the re-scan: finished or open orders (status F, O)."""
    return book_state(spark, sf_dir).filter(F.col("o_orderstatus").isin("F", "O"))


# --- conversations -> OCR result archives -------------------------------------------------------


def _zip_conversation(pdf):
    """One archive per conversation, entries in turn order: assistant turns are markdown
    outputs ``turn_{k}.md``, user turns page metadata ``metadata/page_{k}.json`` (one block,
    confidence = text length % 100 / 100), other turns ``notes/turn_{k}.txt``."""
    import io
    import json
    import zipfile

    import pandas as pd

    pdf = pdf.sort_values("turn")
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as z:
        for turn, role, text in zip(pdf["turn"], pdf["role"], pdf["text"]):
            if role == "assistant":
                z.writestr(f"turn_{turn}.md", text)
            elif role == "user":
                block = {"block_id": f"t{turn}", "confidence": (len(text) % 100) / 100, "text": text}
                z.writestr(f"metadata/page_{turn}.json", json.dumps({"page_num": int(turn), "blocks": [block]}))
            else:
                z.writestr(f"notes/turn_{turn}.txt", text)
    conv = int(pdf["conv_id"].iloc[0])
    return pd.DataFrame({"path": [f"conv_{conv}.zip"], "content": [buf.getvalue()]})


def ocr_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """OCR result archives (``path, content`` like the binaryFile reader), one per
    conversation; an archive is one object, so its size is the conversation's."""
    c = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return c.groupBy("conv_id").applyInPandas(_zip_conversation, "path string, content binary")


# --- documents -> files -------------------------------------------------------------------------


FOLDERS = 1024


def spread_path(folder: str, suffix: str):
    """``<folder>/<n>/<doc_id><suffix>``: many files lie in many folders, which tasks can list apart."""
    return F.concat(F.lit(f"{folder}/"), F.pmod(F.hash("doc_id"), F.lit(FOLDERS)).cast("string"), F.lit("/"), F.col("doc_id").cast("string"), F.lit(suffix))


def pdf_files(spark: SparkSession, sf_dir: str, folder: str) -> DataFrame:
    """``doc_id, path, content`` of a small PDF per document, its text in a stream: by doc_id % 6 good with 1 + n_chars % 700
    pages (0), without its end mark (1), empty (2), without header (3), with 0 pages (4), not there (5: null)."""
    d = ensure_parallelism(table(spark, sf_dir, "documents").select("doc_id", "text", "n_chars"))
    k = F.col("doc_id") % 6
    pages = F.when(k == 4, F.lit(0)).otherwise(F.col("n_chars") % 700 + 1).cast("string")
    head = F.concat(F.lit("%PDF-1.4\n1 0 obj\n<< /Type /Catalog /Pages 2 0 R >>\nendobj\n2 0 obj\n<< /Type /Pages /Kids [] /Count "), pages, F.lit(" >>\nendobj\n3 0 obj\n<< >>\nstream\n"))
    body = F.concat(head, F.coalesce("text", F.lit("")), F.lit("\nendstream\nendobj\n"))
    whole = F.concat(body, F.lit("xref\n0 4\ntrailer\n<< /Root 1 0 R >>\nstartxref\n"), F.octet_length(body).cast("string"), F.lit("\n%%EOF\n"))
    made = d.select("doc_id", k.alias("k"), whole.alias("whole"))
    content = (
        F.when(F.col("k") == 1, F.expr("substring(whole, 1, length(whole) - 6)"))
        .when(F.col("k") == 2, F.lit(""))
        .when(F.col("k") == 3, F.expr("substring(whole, 10)"))
        .when(F.col("k") == 5, F.lit(None).cast("string"))
        .otherwise(F.col("whole"))
    )
    return made.select("doc_id", spread_path(folder, ".pdf").alias("path"), content.alias("content"))
