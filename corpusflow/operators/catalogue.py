"""Catalogue rows -> state rows: file names and artifact paths (P6, P6b, P7, K2), the
PDF filter (F3) and per-page catalogue counts (A6)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusflow.functions.text import combined_slug, scraped_slug, slugify, swap_suffix, zfill_id

# --- fixed values: artifact layout ---------------------------------------------------
RAW_BASE = "raw_pdf"
PROCESSED_BASE = "processed_docs"
SD_RAW_BASE = "/sdcard/raw_pdf"
SD_PROCESSED_BASE = "/sdcard/processed_docs"
# ---------------------------------------------------------------------------------------


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def artifact_path(base: str, page_slug, book_id, file_name) -> Column:
    """K2: ``<base>/<page_slug>/<zfill(id,3)>/<file_name>``."""
    return F.concat_ws("/", F.lit(base), _c(page_slug), zfill_id(_c(book_id)), _c(file_name))


def with_paths(df: DataFrame, file_name: Column, page_slug: str = "page_slug", book_id: str = "id") -> DataFrame:
    """Add the three local paths (raw pdf, md, docx) from a ``.pdf`` file name."""
    return (
        df.withColumn("_fn", file_name)
        .withColumn("local_pdf_path", artifact_path(RAW_BASE, page_slug, book_id, F.col("_fn")))
        .withColumn("local_md_path", artifact_path(PROCESSED_BASE, page_slug, book_id, swap_suffix(F.col("_fn"), ".md")))
        .withColumn(
            "local_docx_path", artifact_path(PROCESSED_BASE, page_slug, book_id, swap_suffix(F.col("_fn"), ".docx"))
        )
        .drop("_fn")
    )


def sd_card_paths(df: DataFrame, page_slug: str = "page_slug", book_id: str = "id") -> DataFrame:
    """K2 second copy: the same file names under the phone-storage bases."""
    fn = lambda c: F.regexp_extract(F.col(c), r"([^/]+)$", 1)
    return (
        df.withColumn("sd_pdf_path", artifact_path(SD_RAW_BASE, page_slug, book_id, fn("local_pdf_path")))
        .withColumn("sd_md_path", artifact_path(SD_PROCESSED_BASE, page_slug, book_id, fn("local_md_path")))
        .withColumn("sd_docx_path", artifact_path(SD_PROCESSED_BASE, page_slug, book_id, fn("local_docx_path")))
    )


def inline_book_rows(books: DataFrame, title_slug_in: str | None = None, author_slug_in: str | None = None) -> DataFrame:
    """State rows for inline (config) books. Explicit slugs in the input win over
    computed ones; file name ``{id}_{ellipsize(strip_('{t}_{a}'), 50)}.pdf``."""
    t = slugify("title_original")
    a = slugify(F.coalesce(F.col("author_original"), F.lit("")))
    if title_slug_in:
        t = F.coalesce(F.col(title_slug_in), t)
    if author_slug_in:
        a = F.coalesce(F.col(author_slug_in), a)
    name = F.concat(F.col("id"), F.lit("_"), combined_slug(t, a), F.lit(".pdf"))
    return with_paths(books, name).withColumn("status", F.lit("pending"))


def scraped_book_rows(items: DataFrame, title_slug: Column, author_slug: Column) -> DataFrame:
    """State rows for scraped books. Each slug is ellipsized separately, empty parts
    dropped; the full slugs stay in the row."""
    df = items.withColumn("title_english_slug", title_slug).withColumn("author_english_slug", author_slug)
    name = F.concat(
        F.col("id"), F.lit("_"), scraped_slug(F.col("title_english_slug"), F.col("author_english_slug")), F.lit(".pdf")
    )
    return with_paths(df, name).withColumn("status", F.lit("pending"))


def pdf_files(listing: DataFrame) -> DataFrame:
    """listing rows whose lower-cased name ends with '.pdf'."""
    return listing.filter(F.lower(F.col("name")).endswith(".pdf"))


def catalogue_counts(items: DataFrame, page_col: str, complete: Column) -> DataFrame:
    """Items found, accepted and rejected per page."""
    return items.groupBy(page_col).agg(
        F.count(F.lit(1)).cast("bigint").alias("n_items"),
        F.count_if(complete).cast("bigint").alias("n_complete"),
        F.count_if(~complete).cast("bigint").alias("n_rejected"),
    )
