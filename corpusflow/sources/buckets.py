"""K1 / J2 by touched pages: a state table of which an upsert rewrites only the page buckets that it touches.

A version ``<root>/v=<n>`` holds folders ``bucket=<k>-<buckets>`` for the buckets that it wrote and counts once its ``_SUCCESS`` is there; a
bucket's rows are in the latest counting version that has its folder. So nothing is overwritten, a torn
write is never read, and an upsert of a few pages reads and writes these pages' buckets alone. A bucket is a hash of the page
slug; within it rows spread over tasks by key, so a page with a third of all rows is one folder of many files.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusflow.operators.state import KEYS, state_upsert
from corpusflow.schemas import BOOK_STATE
from corpusflow.sources import state as SS

BUCKETS = 1024


def bucket_of(page_slug, buckets: int) -> Column:
    """A page's bucket, as it stands in the folder's name (a null slug has one too)."""
    return F.concat(F.pmod(F.xxhash64(page_slug), F.lit(buckets)).cast("string"), F.lit(f"-{buckets}"))


def current_buckets(spark: SparkSession, root: str) -> dict[str, str]:
    """Bucket name -> folder of its rows. A listing of at most versions x buckets names."""
    fs, path, jvm = SS._fs(spark, root)
    found: dict[str, str] = {}
    for v in SS.committed_versions(spark, root):
        for st in fs.listStatus(jvm.org.apache.hadoop.fs.Path(f"{root}/v={v}")):
            name = st.getPath().getName()
            if name.startswith("bucket="):
                found[name.removeprefix("bucket=")] = f"{root}/v={v}/{name}"
    return found


def _read(spark: SparkSession, folders: list[str]) -> DataFrame:
    if not folders:
        return spark.createDataFrame([], BOOK_STATE)
    return SS.conform(spark.read.schema(BOOK_STATE).parquet(*folders))


def _write(rows: DataFrame, root: str, buckets: int) -> int:
    spark = rows.sparkSession
    version = SS.next_version(spark, root)
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # a bucket's rows go to one task, a large one's (by AQE's measure) to several
    dealt = SS.conform(rows).withColumn("bucket", bucket_of(F.col("page_slug"), buckets)).hint("rebalance", tasks, F.col("bucket"))
    dealt.sortWithinPartitions("bucket", *KEYS).write.mode("errorifexists").partitionBy("bucket").parquet(f"{root}/v={version}")
    return version


def save_buckets(state: DataFrame, root: str, buckets: int = BUCKETS) -> int:
    """Write the whole state as a version with every bucket that has rows."""
    return _write(state, root, buckets)


def load_buckets(spark: SparkSession, root: str, pages: list[str] | None = None) -> DataFrame:
    """The state; with ``pages`` only these pages' buckets are opened."""
    now = current_buckets(spark, root)
    if pages is None:
        return _read(spark, list(now.values()))
    wanted = _names(spark.createDataFrame([(p,) for p in pages], "page_slug string"), now)
    return _read(spark, [f for b, f in now.items() if b in wanted]).where(F.col("page_slug").isin(pages))


def _buckets(now: dict[str, str], default: int) -> int:
    """Number of buckets of a table (its folders say it), ``default`` for a new one."""
    return int(next(iter(now)).partition("-")[2]) if now else default


def _names(pages: DataFrame, now: dict[str, str], default: int = BUCKETS) -> set[str]:
    """The buckets of ``pages(page_slug)``: at most as many as there are buckets."""
    n = _buckets(now, default)
    return {r["b"] for r in pages.select(bucket_of(F.col("page_slug"), n).alias("b")).distinct().collect()}


def upsert_pages(spark: SparkSession, root: str, batch: DataFrame, buckets: int = BUCKETS) -> tuple[int, int]:
    """J2 of ``batch`` (one row a key) into the table: (version, buckets written). Untouched buckets are neither
    read nor written."""
    now = current_buckets(spark, root)
    touched = _names(batch, now, buckets)
    state = _read(spark, [now[b] for b in sorted(touched) if b in now])
    return _write(state_upsert(state, batch), root, _buckets(now, buckets)), len(touched)
