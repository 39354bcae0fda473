"""The book-state table.

State is a Parquet table written as immutable versions ``<root>/v=<n>``; a version
counts only once its ``_SUCCESS`` marker exists, so a reader never sees a half
written version and a writer never overwrites the path it reads from.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusflow.schemas import BOOK_STATE, STATE_COLUMNS


def _fs(spark: SparkSession, root: str):
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(root)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path, jvm


def exists(spark: SparkSession, path: str) -> bool:
    fs, at, _ = _fs(spark, path)
    return fs.exists(at)


def _versions(spark: SparkSession, root: str, committed_only: bool) -> list[int]:
    fs, path, jvm = _fs(spark, root)
    if not fs.exists(path):
        return []
    out = []
    for st in fs.listStatus(path):
        name = st.getPath().getName()
        if not (name.startswith("v=") and name[2:].isdigit()):
            continue
        if committed_only and not fs.exists(jvm.org.apache.hadoop.fs.Path(st.getPath(), "_SUCCESS")):
            continue
        out.append(int(name[2:]))
    return sorted(out)


def committed_versions(spark: SparkSession, root: str) -> list[int]:
    """Versions whose write finished (``_SUCCESS`` present); only these are read."""
    return _versions(spark, root, committed_only=True)


def conform(df: DataFrame) -> DataFrame:
    """Project onto the state schema; missing optional keys become null."""
    return df.select(
        *[(F.col(c) if c in df.columns else F.lit(None)).cast("string").alias(c) for c in STATE_COLUMNS]
    )


def load_state(spark: SparkSession, root: str) -> DataFrame:
    """Latest committed version; no state yet -> empty table with the state schema."""
    vs = committed_versions(spark, root)
    if not vs:
        return spark.createDataFrame([], BOOK_STATE)
    return conform(spark.read.schema(BOOK_STATE).parquet(f"{root}/v={vs[-1]}"))


def load_state_json(spark: SparkSession, path: str, page_slug: str | None = None) -> DataFrame:
    """The reference layout: one ``{"books": [...]}`` JSON document per page."""
    from pyspark.sql import types as T

    doc = T.StructType([T.StructField("books", T.ArrayType(BOOK_STATE))])
    raw = spark.read.schema(doc).option("multiLine", True).json(path)
    rows = raw.select(F.explode("books").alias("b")).select("b.*")
    if page_slug is not None:
        rows = rows.withColumn("page_slug", F.lit(page_slug))
    return conform(rows)


def next_version(spark: SparkSession, root: str) -> int:
    """A number past every folder, committed or not: a write that died midway leaves a folder
    without _SUCCESS, which is never read and never reused."""
    vs = _versions(spark, root, committed_only=False)
    return (vs[-1] + 1) if vs else 1


def save_state(df: DataFrame, root: str, version: int | None = None) -> int:
    """K1: write a new committed version and return its number (``version``, or the next one).

    One layout whatever the number of pages: a table with ``page_slug`` as a data column
    (an empty slug stays an empty slug), range-clustered and sorted on (page_slug, id). Each
    task writes a few contiguous pages, a page with a third of all rows spans several tasks,
    and Parquet's min/max statistics on page_slug let page filters skip files and row groups."""
    spark = df.sparkSession
    v = version or next_version(spark, root)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = conform(df).repartitionByRange(n, "page_slug", "id").sortWithinPartitions("page_slug", "id")
    rows.write.mode("errorifexists").parquet(f"{root}/v={v}")
    return v


# --- the ledger of streams that write the state ------------------------------------------------

LEDGER = "stream string, batch_id long"


def save_ledger(spark: SparkSession, root: str, version: int, ledger: dict[str, int]) -> None:
    """Write the last batch of every stream that ``version`` holds (a row a stream). It is written before the
    version and counts only once the version is committed, so both take effect in one step."""
    rows = spark.createDataFrame(sorted(ledger.items()), LEDGER)
    rows.coalesce(1).write.mode("errorifexists").parquet(f"{root}/_ledger/v={version}")


def load_ledger(spark: SparkSession, root: str) -> dict[str, int]:
    """The last batch of every stream in the latest committed version; a version that a batch job wrote
    passes on the ledger before it."""
    fs, path, jvm = _fs(spark, root)
    for v in reversed(committed_versions(spark, root)):
        at = f"{root}/_ledger/v={v}"
        if fs.exists(jvm.org.apache.hadoop.fs.Path(at, "_SUCCESS")):
            return {r["stream"]: r["batch_id"] for r in spark.read.schema(LEDGER).parquet(at).collect()}
    return {}
