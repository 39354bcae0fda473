"""K3 / K4: markdown outputs.

``write_merged`` produces one markdown file per document whose bytes equal the ordered
merge (A3) — each chunk followed by the separator — without building the document as
one cell: rows are clustered by document, sorted by part inside each task and written
by the text source, which appends the line separator after every row. The separator
ends with a newline, so each row carries the separator minus that newline.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusflow.operators.chunks import CHUNK_SEPARATOR
from corpusflow.sources.filesystem import write_files


def write_merged(
    texts: DataFrame, doc_col: str, part_col: str, text_col: str, out_dir: str, sep: str = CHUNK_SEPARATOR, partitions: int | None = None
) -> None:
    """One ``<out_dir>/<doc_col>=<doc>/part-*.txt`` file per document with the merged text."""
    if not sep.endswith("\n"):
        raise ValueError("the separator must end with a newline (it becomes the line separator)")
    spark = texts.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = texts.select(F.col(doc_col), F.col(part_col), F.concat(F.col(text_col), F.lit(sep[:-1])).alias("value"))
    (
        rows.repartition(n, doc_col)
        .sortWithinPartitions(doc_col, part_col)
        .drop(part_col)
        .write.mode("errorifexists")
        .option("lineSep", "\n")
        .partitionBy(doc_col)
        .text(out_dir)
    )


def write_placeholders(rows: DataFrame, path_col: str, placeholder_col: str) -> int:
    """K4: the placeholder markdown of every row, exactly these bytes under its own path (a full URI)."""
    files = rows.select(F.col(path_col).alias("path"), F.col(placeholder_col).alias("content"))
    # few bytes but many files: dealt by number, which no plan would do by size
    return write_files(files.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), "path"))
