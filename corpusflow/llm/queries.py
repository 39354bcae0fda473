"""The operators of this folder over the given tables, one query each."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .common import table


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .toxicity import toxicity

    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .simhash import simhash_components

    return simhash_components(table(spark, sf_dir, "documents"))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .mixing import mix

    return mix(table(spark, sf_dir, "documents"))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .token_counts import token_counts

    return token_counts(table(spark, sf_dir, "documents"))


def op5_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .licenses import license_scan

    return license_scan(table(spark, sf_dir, "documents")).drop("detections")


def op6_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from .pii import personal_data

    found = personal_data(table(spark, sf_dir, "documents"))
    return found.withColumn("base", F.sha2("base", 256)).withColumnRenamed("base", "base_sha256")


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality import quality

    return quality(table(spark, sf_dir, "documents")).drop("char_distance", "word_distance")


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .decontaminate import contamination

    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("spans")


def op9_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .passages import repeated_passages

    return repeated_passages(table(spark, sf_dir, "documents"))


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .token_files import token_files

    return token_files(table(spark, sf_dir, "documents"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .periodic_runs import periodic_runs, run_summary, with_planted_runs

    return run_summary(periodic_runs(with_planted_runs(table(spark, sf_dir, "documents"))))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .prefix_trie import node_table, prefix_trie, rebuilt

    return node_table(prefix_trie(*rebuilt(table(spark, sf_dir, "conversations"))))


def op13_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .packing import packed_documents

    return packed_documents(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_toxicity, op2_simhash_near_dedup, op3_mixing, op4_token_counts, op5_licenses, op6_personal_data, op7_quality, op8_decontamination, op9_passages, op10_token_files, op11_periodic_runs, op12_prefix_trie, op13_packing)
}
