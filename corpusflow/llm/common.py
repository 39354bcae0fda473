"""Small helpers that the operators of this folder share."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusflow.session import ship_package, work_dir

# The contracts' white space (\x20 and \x09-\x0D) and non-word ASCII, as runs.
SPACE_RUN = r"[\x20\x09-\x0D]+"
NON_WORD_RUN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Rows handed to a Python worker at once; documents may be long, so a batch stays small.
ARROW_ROWS = 500


def prepare(spark: SparkSession) -> SparkSession:
    """Register the shared folder, ship the package to the workers, keep Arrow batches small."""
    work_dir(spark)
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    return spark


_MADE: dict[str, object] = {}


def once(key: str, make):
    """``make()`` once for ``key`` in a worker process; a new key replaces what was kept before."""
    if key not in _MADE:
        _MADE.clear()
        _MADE[key] = make()
    return _MADE[key]


def new_key() -> str:
    return uuid.uuid4().hex


def shared_path(spark: SparkSession, name: str) -> str:
    """A new place below ``spark.checkpoint.dir``, as a full URI."""
    work_dir(spark)
    base = spark.sparkContext.getCheckpointDir()
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: a lineage cut that every executor can read."""
    path = shared_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what is run inside go as soon as it has run: its result is stored, nothing reads them again.
    Without this they stay until the driver's JVM happens to collect the plan."""
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, before)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(c: Column) -> Column:
    """A-Z to a-z, nothing else (``lower`` would change other letters too)."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def count_of(c: Column, form: str) -> Column:
    """Number of characters in runs of a character class (an expression that matches runs)."""
    return F.length(c) - F.length(F.regexp_replace(c, form, ""))


def word_string(c: Column) -> Column:
    """Lower-cased words of the class ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]``, one blank between
    them, none at the ends; null gives the empty string."""
    return F.trim(F.regexp_replace(ascii_lower(F.coalesce(c, F.lit(""))), NON_WORD_RUN, " "))


def word_array(words: Column) -> Column:
    """The words of a :func:`word_string`; no word gives an empty array."""
    return F.when(words == "", F.array().cast("array<string>")).otherwise(F.split(words, " "))


def word_hashes(words: Column) -> Column:
    """A 64-bit hash of each word."""
    return F.transform(words, lambda w: F.xxhash64(w))


def shingle_hash(hashes: Column, at: Column, k: int) -> Column:
    """Hash of the ``k`` words from ``at`` (0-based) on, from their hashes."""
    return F.xxhash64(*[F.get(hashes, at + j) for j in range(k)])


def fixed(df: DataFrame, **cols: Column) -> DataFrame:
    """``df`` with ``cols``, computed once a row: a one-element ``inline`` stops the optimizer from
    pasting a costly expression into every place (and every lambda round) that uses it."""
    made = F.array(F.struct(*[c.alias(k) for k, c in cols.items()]))
    return df.select("*", F.inline(made))


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once."""
    return F.element_at(F.transform(F.array(value), body), 1)
