"""Chunking and re-assembly: plan (C1), names (C2), slices (C3), pre-check triage (C4),
per-chunk output join (J6), all-or-nothing success (A2), ordered merge (A3) and first
matching archive entry (W4)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- fixed values ---------------------------------------------------------------------
PAGE_LIMIT = 500
CHUNK_SEPARATOR = "\n\n---\n\n"
MSG_NOT_FOUND = "PDF file not found."
MSG_CORRUPTED = "Corrupted PDF file: "
MSG_READ_ERROR = "Error reading PDF file: "
PLACEHOLDER_FAILED = "# OCR Failed for {file}\n\nError: {error}\nThis is a placeholder Markdown file due to PDF pre-check failure."
PLACEHOLDER_SKIPPED = "# OCR Skipped for {file}\n\nThis is a placeholder Markdown file as {service} OCR was disabled for testing purposes."
# ----------------------------------------------------------------------------------------


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def chunk_plan(df: DataFrame, pages_col: str, limit: int = PAGE_LIMIT) -> DataFrame:
    """More than ``limit`` pages -> parts of at most ``limit`` pages (part 1-based,
    start 0-based, end exclusive); otherwise one whole-document row with a null part.
    ``n_parts`` is the chunk count of the document (W3's total for chunks), computed per row
    without an aggregation."""
    n = F.col(pages_col).cast("bigint")
    nparts = F.ceil(n / F.lit(limit)).cast("bigint")
    parts = F.when(n > limit, F.sequence(F.lit(1).cast("bigint"), nparts)).otherwise(F.array(F.lit(None).cast("bigint")))
    ex = df.withColumn("part", F.explode(parts))
    start = F.when(F.col("part").isNull(), F.lit(0).cast("bigint")).otherwise((F.col("part") - 1) * limit)
    end = F.when(F.col("part").isNull(), n).otherwise(F.least(F.col("part") * limit, n))
    n_parts = F.when(n > limit, nparts).otherwise(F.lit(1).cast("bigint"))
    return ex.withColumn("start_page", start).withColumn("end_page", end).withColumn("n_parts", n_parts)


def chunk_names(plan: DataFrame, stem_col: str) -> DataFrame:
    """``{stem}_chunks/{stem}_part_{k}.pdf`` and ``{stem}_part_{k}.md`` (null part ->
    the document's own names)."""
    s = F.col(stem_col)
    k = F.col("part").cast("string")
    pdf = F.when(F.col("part").isNotNull(), F.concat(s, F.lit("_chunks/"), s, F.lit("_part_"), k, F.lit(".pdf"))).otherwise(
        F.concat(s, F.lit(".pdf"))
    )
    md = F.when(F.col("part").isNotNull(), F.concat(s, F.lit("_part_"), k, F.lit(".md"))).otherwise(F.concat(s, F.lit(".md")))
    return plan.withColumn("chunk_pdf", pdf).withColumn("chunk_md", md)


def chunk_slices(plan: DataFrame, text_col: str, out: str = "slice") -> DataFrame:
    """The units [start, end) of each chunk (characters of a text here)."""
    return plan.withColumn(
        out, F.expr(f"substring(`{text_col}`, cast(start_page + 1 as int), cast(end_page - start_page as int))")
    )


def precheck_error(present, parse_error, corrupted) -> Column:
    """C4: missing -> 'PDF file not found.'; a parse error -> 'Corrupted PDF file: …' when
    the reader reports corruption, else 'Error reading PDF file: …'; null when it passes
    (0 pages passes)."""
    return (
        F.when(~_c(present), F.lit(MSG_NOT_FOUND))
        .when(_c(parse_error).isNotNull() & _c(corrupted), F.concat(F.lit(MSG_CORRUPTED), _c(parse_error)))
        .when(_c(parse_error).isNotNull(), F.concat(F.lit(MSG_READ_ERROR), _c(parse_error)))
    )


def pdf_structure(content) -> tuple[Column, Column, Column, Column]:
    """(text, cross-reference offset, error, page count) of a PDF file's bytes, from its header, trailer and page tree: a header within
    the first and an end mark within the last 1,024 bytes, a cross-reference offset that points to a table or an
    object, and ``/Count`` of the page tree's root (a ``/Pages`` object without ``/Parent``), else the number of ``/Page``
    objects. ``page_count`` is null where objects are compressed, so that no page tree is in sight; such a
    file passes but needs a reader for its pages. The bytes are read as Latin-1, one character a byte.
    The later columns refer to the text as ``_t`` and to the offset as ``_offset``."""
    text = F.decode(_c(content), "ISO-8859-1")
    tail = F.expr("right(_t, 1024)")
    offset = F.regexp_extract(tail, r"(?s).*startxref\s+(\d+)", 1).try_cast("int")
    objects = F.split(F.col("_t"), "endobj")
    trees = F.filter(objects, lambda o: o.rlike(r"/Type\s*/Pages\b"))
    root = F.get(F.filter(trees, lambda o: ~o.contains("/Parent")), 0)
    leaves = F.size(F.filter(objects, lambda o: o.rlike(r"/Type\s*/Page\b")))
    count = F.coalesce(F.regexp_extract(root, r"/Count\s+(\d+)", 1).try_cast("bigint"), F.when(leaves > 0, leaves.cast("bigint")))
    error = (
        F.when(F.length("_t") == 0, F.lit("Cannot read an empty file"))
        .when(~F.substring("_t", 1, 1024).contains("%PDF-"), F.lit("invalid pdf header"))
        .when(~tail.contains("%%EOF"), F.lit("EOF marker not found"))
        .when(offset.isNull(), F.lit("startxref not found"))
        .when(~F.expr("substring(_t, _offset + 1, 32)").rlike(r"^\s*(xref|\d+\s+\d+\s+obj)"), F.lit("startxref points outside the cross-reference table"))
    )
    return text, offset, error, count


def precheck_files(files: DataFrame, content_col: str = "content", out_of_reach: str | None = None) -> DataFrame:
    """C4 on files: ``files(.., content)`` (null: the file isn't there) with ``precheck_error`` and ``page_count`` (0 on an error).
    ``out_of_reach`` may name a boolean column of files that are there but couldn't be read."""
    text, offset, error, count = pdf_structure(content_col)
    parsed = files.withColumn("_t", text).withColumn("_offset", offset).withColumn("_error", error).withColumn("_count", count)
    unread = F.coalesce(F.col(out_of_reach), F.lit(False)) if out_of_reach else F.lit(False)
    wrong = F.when(unread, F.lit("the file can't be read")).otherwise(F.col("_error"))
    checked = parsed.withColumn("precheck_error", precheck_error(F.col(content_col).isNotNull() | unread, wrong, ~unread))
    pages = F.when(F.col("precheck_error").isNotNull(), F.lit(0).cast("bigint")).otherwise(F.col("_count"))
    return checked.withColumn("page_count", pages).drop("_t", "_offset", "_error", "_count")


def precheck_expected(expected: DataFrame, checked: DataFrame, key: str) -> DataFrame:
    """C4 against a list: rows of ``expected`` with the ``precheck_error`` and ``page_count`` that ``checked(key, ..)``, from
    :func:`precheck_files`, has of their file; a file that isn't there fails. Files are checked where they are read, so that no
    content is joined. The join is sorted whatever sizes are expected: a listing of files says little of what is read from them."""
    c = checked.select(F.col(key).alias("_key"), F.col("precheck_error").alias("_error"), F.col("page_count").alias("_count"))
    there = F.col("_key").isNotNull()
    j = expected.join(c.hint("merge"), expected[key] == c["_key"], "left")
    error = F.when(there, F.col("_error")).otherwise(F.lit(MSG_NOT_FOUND))
    pages = F.when(there, F.col("_count")).otherwise(F.lit(0).cast("bigint"))
    return j.withColumn("precheck_error", error).withColumn("page_count", pages).drop("_key", "_error", "_count")


def failed_placeholder(file_name, error) -> Column:
    """K4: markdown written for a failed pre-check (still counted as failed)."""
    head, rest = PLACEHOLDER_FAILED.split("{file}")
    mid, tail = rest.split("{error}")
    return F.concat(F.lit(head), _c(file_name), F.lit(mid), _c(error), F.lit(tail))


def skipped_placeholder(file_name, service: str = "the") -> Column:
    """K4 second template: OCR disabled."""
    head, rest = PLACEHOLDER_SKIPPED.split("{file}")
    return F.concat(F.lit(head), _c(file_name), F.lit(rest.replace("{service}", service)))


def chunk_outputs(plan: DataFrame, texts: DataFrame, metas: DataFrame, keys: list[str]) -> DataFrame:
    """A chunk is good only when both its text and its metadata exist; repeated rows count once."""
    t = texts.select(*keys, F.lit(True).alias("has_text")).distinct()
    m = metas.select(*keys, F.lit(True).alias("has_metadata")).distinct()
    j = plan.join(t, keys, "left").join(m, keys, "left")
    return (
        j.withColumn("has_text", F.coalesce(F.col("has_text"), F.lit(False)))
        .withColumn("has_metadata", F.coalesce(F.col("has_metadata"), F.lit(False)))
        .withColumn("good", F.col("has_text") & F.col("has_metadata"))
    )


def document_success(chunks: DataFrame, doc_col: str, good_col: str = "good") -> DataFrame:
    """A2: a document succeeds only if every chunk did (partial aggregation)."""
    return chunks.groupBy(doc_col).agg(
        F.count(F.lit(1)).cast("bigint").alias("n_chunks"),
        F.count_if(F.col(good_col)).cast("bigint").alias("n_good"),
        F.bool_and(F.col(good_col)).alias("success"),
    )


def ordered_merge(texts: DataFrame, doc_col: str, part_col: str, text_col: str, sep: str = CHUNK_SEPARATOR) -> DataFrame:
    """A3: chunk texts concatenated in part order, each followed by ``sep`` (the last too).

    One output cell per document: its size is the document's own size, so documents are
    bounded by the 2 GB cell limit; ``sinks.text.write_merged`` writes the same result
    without ever building the cell."""
    parts = F.array_sort(F.collect_list(F.struct(F.col(part_col).alias("p"), F.col(text_col).alias("t"))))
    return texts.groupBy(doc_col).agg(
        F.count(F.lit(1)).cast("bigint").alias("n_parts"),
        F.array_join(F.transform(parts, lambda x: F.concat(x["t"], F.lit(sep))), "").alias("merged_text"),
    )


def first_entry(entries: DataFrame, group: list[str], pos_col: str, value_col: str, predicate: Column, out: str) -> DataFrame:
    """Value of the first entry (by position) satisfying ``predicate``, per group."""
    return entries.groupBy(*group).agg(F.min_by(F.col(value_col), F.when(predicate, F.col(pos_col))).alias(out))
