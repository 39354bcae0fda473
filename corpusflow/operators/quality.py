"""OCR quality: metadata union (U2), low-confidence blocks (F5), per-document metrics
(A1), distinct low pages (A7) and metadata file order (O2)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# --- fixed values ------------------------------------------------------------------------
CONFIDENCE_THRESHOLD = 0.7
# -------------------------------------------------------------------------------------------


def merge_metadata(frames: list[DataFrame]) -> DataFrame:
    """Union of the chunks' page metadata, keyed by (doc, part, page) so equal file
    names in two chunks no longer overwrite each other."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def low_confidence_blocks(blocks: DataFrame, threshold: float = CONFIDENCE_THRESHOLD) -> DataFrame:
    """blocks with confidence strictly below the threshold. This flat table is the
    detail list of A1; its (file_name, block_pos) columns give the reference order."""
    return blocks.filter(F.col("confidence") < F.lit(threshold))


def confidence_metrics(
    blocks: DataFrame, docs: DataFrame, doc_col: str, page_col: str = "page_num", threshold: float = CONFIDENCE_THRESHOLD
) -> DataFrame:
    """A1: per document — mean confidence over blocks (null without blocks), number of
    blocks below the threshold, sorted distinct pages having such a block ([] if none).
    Every document of ``docs`` gets a row. Partial aggregation; the page set is bounded by
    the document's page count."""
    low = F.col("confidence") < F.lit(threshold)
    agg = blocks.groupBy(doc_col).agg(
        F.avg("confidence").alias("avg_page_confidence"),
        F.count_if(low).cast("bigint").alias("low_confidence_blocks_count"),
        F.array_sort(F.collect_set(F.when(low, F.col(page_col)))).alias("pages_with_low_confidence_blocks"),
    )
    j = docs.select(doc_col).join(agg, doc_col, "left")
    return j.select(
        doc_col,
        "avg_page_confidence",
        F.coalesce(F.col("low_confidence_blocks_count"), F.lit(0).cast("bigint")).alias("low_confidence_blocks_count"),
        F.coalesce(F.col("pages_with_low_confidence_blocks"), F.array().cast("array<int>")).alias(
            "pages_with_low_confidence_blocks"
        ),
    )


def distinct_low_pages(blocks: DataFrame, doc_col: str, page_col: str = "page_num", threshold: float = CONFIDENCE_THRESHOLD) -> DataFrame:
    """Distinct (document, page) pairs having a low-confidence block."""
    return low_confidence_blocks(blocks, threshold).select(doc_col, page_col).distinct()


def sort_metadata(pages: DataFrame, doc_col: str, name_col: str = "file_name", tie: list[str] | None = None) -> DataFrame:
    """O2: position of each metadata file in lexicographic name order per document
    ('page_10' before 'page_2'). A group is one document's files, so a plain window does."""
    order = Window.partitionBy(doc_col).orderBy(name_col, *(tie or []))
    return pages.withColumn("file_rank", F.row_number().over(order).cast("bigint"))


def low_confidence_details(blocks: DataFrame, doc_col: str, threshold: float = CONFIDENCE_THRESHOLD) -> DataFrame:
    """A1's detail list as flat rows: every low-confidence block with its text and its
    position (``detail_pos``, 1-based) in file, part and block order of the document."""
    order = Window.partitionBy(doc_col).orderBy("file_name", "part", "block_pos")
    return low_confidence_blocks(blocks, threshold).withColumn("detail_pos", F.row_number().over(order).cast("bigint"))
