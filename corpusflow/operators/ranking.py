"""Skew-safe ranking and a parallelism floor.

``row_number() OVER (PARTITION BY key ORDER BY ...)`` puts a whole key group in
one task; when one key holds a third of all rows that task holds a third of the
data. ``number_within`` gives the exact same numbers without that: rows get the number of the range of
``(key, order)`` that they fall into, so a hot key is cut into many ranges; a window numbers each (range,
key) on its own, and a small table of counts by (range, key) supplies the offset of every slice.
Nothing is written: the ranges' bounds are values that were read once, so every evaluation cuts the
rows alike.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Sampled rows a range; the bounds are their quantiles.
SAMPLED = 64


def _cols(xs) -> list[Column]:
    return [F.col(x) if isinstance(x, str) else x for x in xs]


def _names(xs) -> list[str]:
    out = []
    for x in xs:
        if not isinstance(x, str):
            raise TypeError("keys must be column names")
        out.append(x)
    return out


def number_within(df: DataFrame, keys: list[str], order: list, out: str = "rn", total: str | None = None, partitions: int | None = None) -> DataFrame:
    """Add ``out`` = 1-based position of each row within its ``keys`` group by ``order`` (names or
    expressions, ascending, nulls first) and optionally ``total`` = group size. ``order`` must be a total order
    within a group (append a unique tie-break) for the numbering to be deterministic; ``df`` is read three times.
    ``keys`` may be empty (one global numbering)."""
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = _names(keys)
    tagged = range_tagged(df, [*keys, *order], n)
    # at most one row per (range, key): a key in one range only, or one of the few that a bound cuts
    stats = tagged.groupBy("_rp", *keys).agg(F.count(F.lit(1)).alias("_cnt"))
    across = Window.partitionBy(*keys).orderBy("_rp").rowsBetween(Window.unboundedPreceding, -1)
    offsets = [F.coalesce(F.sum("_cnt").over(across), F.lit(0)).alias("_base")]
    if total:
        offsets.append(F.sum("_cnt").over(Window.partitionBy(*keys)).alias("_tot"))
    renamed = {k: f"_key{i}" for i, k in enumerate(keys)}
    stats = stats.select(F.col("_rp").alias("_srp"), *[F.col(k).alias(v) for k, v in renamed.items()], *offsets)
    numbered = tagged.withColumn("_pos", F.row_number().over(Window.partitionBy("_rp", *keys).orderBy(*[c.asc_nulls_first() for c in _cols(order)])))
    cond = [F.col("_rp") == F.col("_srp")] + [F.col(k).eqNullSafe(F.col(v)) for k, v in renamed.items()]
    joined = numbered.join(stats, reduce(lambda a, b: a & b, cond), "inner")
    outcols = [F.col(c) for c in df.columns] + [(F.col("_pos") + F.col("_base")).cast("bigint").alias(out)]
    if total:
        outcols.append(F.col("_tot").cast("bigint").alias(total))
    return joined.select(*outcols)


def range_bounds(df: DataFrame, ordering: list, n: int) -> list:
    """At most ``n`` - 1 rows of ``ordering`` values that cut ``df`` into about equal ranges: quantiles of
    the ``SAMPLED * n`` rows whose values' hashes are least. The sample is the same whatever the partitions,
    and its size depends on ``n`` alone."""
    values = df.select(*[c.alias(f"_o{i}") for i, c in enumerate(_cols(ordering))])
    sample = values.orderBy(F.xxhash64(*values.columns)).limit(SAMPLED * n)
    rows = sample.orderBy(*[F.col(c).asc_nulls_first() for c in values.columns]).collect()
    cuts = [rows[i * len(rows) // n] for i in range(1, n)] if rows else []
    return [r for i, r in enumerate(cuts) if not i or r != cuts[i - 1]]


def range_tagged(df: DataFrame, ordering: list, n: int) -> DataFrame:
    """``df`` with ``_rp``, the number of the row's range by ``ordering`` (ascending, nulls first), 0 to ``n`` - 1."""
    cuts = range_bounds(df, ordering, n)
    if not cuts:
        return df.withColumn("_rp", F.lit(0))
    own = F.struct(*[c.alias(f"_o{i}") for i, c in enumerate(_cols(ordering))])
    types = df.select(own.alias("_o")).schema[0].dataType
    bounds = F.array(*[F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(r, types)]) for r in cuts])
    # two steps over about sqrt(n) bounds each
    step = max(1, round(len(cuts) ** 0.5))
    coarse = F.array(*[F.get(bounds, F.lit(i)) for i in range(0, len(cuts), step)])
    reached = lambda some: F.size(F.filter(some, lambda b: b <= own))
    block = F.greatest(reached(coarse) - 1, F.lit(0)) * step
    return df.withColumn("_rp", block).withColumn("_rp", F.col("_rp") + reached(F.slice(bounds, F.col("_rp") + 1, step)))


def ensure_parallelism(df: DataFrame, min_partitions: int | None = None, by: list[str] | None = None) -> DataFrame:
    """Parallelism floor for CPU-heavy per-row work (regex over whole texts, hashing,
    building nested documents).

    A scan yields one task per file split; a few large single-row-group files would leave
    the cluster idle. Only then are rows spread over ``min_partitions`` (default: the
    cluster's default parallelism) — round-robin, or hashed on ``by`` when a grouping on
    those columns follows (the grouping then reuses this partitioning, no extra exchange).
    An input that is already split at least that wide is returned unchanged, so no
    shuffle is added at scale."""
    spark = df.sparkSession
    try:
        want = min_partitions or spark.sparkContext.defaultParallelism
        have = df.rdd.getNumPartitions()
    except Exception:  # no RDD view of the plan (e.g. Spark Connect): leave it to the scan
        return df
    if have >= want:
        return df
    return df.repartition(want, *by) if by else df.repartition(want)
