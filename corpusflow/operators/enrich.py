"""Cached enrichment (X1), slug-cache reuse (J3) and OCR job-result ingest."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusflow.functions.text import ascii_fold, slugify
from corpusflow.session import scratch

# --- fixed values ---------------------------------------------------------------------
JOB_COMPLETED = "Completed"
# ----------------------------------------------------------------------------------------

Provider = Callable[[pd.Series], pd.Series]


def slug_cache_join(items: DataFrame, cache: DataFrame, key: str, title_slug, author_slug) -> DataFrame:
    """Reuse both cached slugs only when both are non-empty; otherwise compute both.
    ``title_slug`` / ``author_slug`` are the computed Column expressions."""
    c = cache.select(
        F.col(key).alias("_ck"), F.col("title_english_slug").alias("_ct"), F.col("author_english_slug").alias("_ca")
    )
    j = items.join(c, items[key] == c["_ck"], "left")
    use = (F.coalesce(F.col("_ct"), F.lit("")) != "") & (F.coalesce(F.col("_ca"), F.lit("")) != "")
    return (
        j.withColumn("title_english_slug", F.when(use, F.col("_ct")).otherwise(title_slug))
        .withColumn("author_english_slug", F.when(use, F.col("_ca")).otherwise(author_slug))
        .withColumn("from_cache", use)
        .drop("_ck", "_ct", "_ca")
    )


def to_enrich(items: DataFrame, cache: DataFrame, key: str) -> DataFrame:
    """J3 to-do set: items whose cached slugs are missing or incomplete."""
    ok = cache.filter((F.coalesce(F.col("title_english_slug"), F.lit("")) != "") & (F.coalesce(F.col("author_english_slug"), F.lit("")) != ""))
    return items.join(ok.select(key), key, "left_anti")


def _single(provider: Provider, text: str) -> str | None:
    try:
        return list(provider(pd.Series([text])))[0]
    except Exception:
        return None


def _provider_udf(provider: Provider):
    def run(batches):
        for pdf in batches:
            texts = pdf["text"]
            try:
                answers = list(provider(texts))
            except Exception:  # one text may have failed the call: ask for each on its own
                answers = [_single(provider, t) for t in texts]
            yield pd.DataFrame({"text": texts, "answer": pd.Series(answers, index=texts.index, dtype=object)})

    return run


def enrich_cached(
    df: DataFrame,
    text_col: str,
    provider: Provider | None = None,
    cache: DataFrame | None = None,
    cache_out: str | None = None,
    parallelism: int | None = None,
    out: str = "slug",
) -> DataFrame:
    """Map each *distinct* text through ``provider`` once and slugify the answer.
    Empty text -> ''; no provider, a failed call or a missing (null) answer -> ascii fold;
    an empty answer -> ''. Only answers are cached, so a failed text is asked again next time.

    distinct -> left_anti against the cache -> repartition -> mapInPandas(provider)
    -> written to a folder of this run below ``cache_out`` (``run=<id>``; answers are not
    deterministic and tasks retry, so new entries are persisted before they are joined
    back; ``cache`` may be read from ``cache_out`` itself) -> left join on one row a text."""
    spark = df.sparkSession
    texts = df.select(F.col(text_col).alias("text")).where(F.col("text").isNotNull()).distinct()
    if cache is not None:
        cache = cache.groupBy("text").agg(F.min(out).alias(out))
        texts = texts.join(cache.select("text"), "text", "left_anti")
    table = cache
    if provider is not None:
        n = parallelism or int(spark.conf.get("spark.sql.shuffle.partitions"))
        answered = texts.repartition(n, "text").mapInPandas(_provider_udf(provider), "text string, answer string")
        fresh = answered.where(F.col("answer").isNotNull()).select("text", slugify("answer").alias(out))
        path = f"{cache_out.rstrip('/')}/run={uuid.uuid4().hex}" if cache_out else scratch(spark, "enrich-cache")
        fresh.write.parquet(path)
        fresh = spark.read.schema(f"text string, {out} string").parquet(path)
        table = fresh if cache is None else cache.select("text", out).unionByName(fresh)
    if table is None:
        j = df.withColumn(out, ascii_fold(text_col))
    else:
        found = table.select(F.col("text").alias("_etext"), F.col(out).alias("_found"))
        j = df.join(found, F.col(text_col) == F.col("_etext"), "left").withColumn(out, F.coalesce("_found", ascii_fold(text_col))).drop("_etext", "_found")
    return j.withColumn(out, F.when(F.coalesce(F.col(text_col), F.lit("")) == "", F.lit("")).otherwise(F.col(out)))


def ingest_results(results: DataFrame, doc_col: str, state_col: str = "job_state") -> tuple[DataFrame, DataFrame]:
    """Job outcomes -> (per-document acceptance, rejected jobs). A job is accepted
    only in state 'Completed'; a document only when all its jobs are."""
    ok = F.coalesce(F.col(state_col) == F.lit(JOB_COMPLETED), F.lit(False))
    per_doc = results.groupBy(doc_col).agg(
        F.count(F.lit(1)).cast("bigint").alias("n_jobs"),
        F.count_if(ok).cast("bigint").alias("n_completed"),
        F.bool_and(ok).alias("accepted"),
    )
    reason = F.coalesce(F.concat(F.lit("job state is "), F.col(state_col)), F.lit("job state is missing"))
    return per_doc, results.filter(~ok).withColumn("reason", reason)
