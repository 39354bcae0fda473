"""The corpus pipeline: toxicity, SimHash near-dedup, benchmark decontamination, mixing, token files.

Each stage takes (spark, docs, sf_dir); its result is written as Parquet and read again as the next
stage's ``docs``. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from corpusflow.llm.common import prepare, stored, table
from corpusflow.llm.decontaminate import drop_contaminated
from corpusflow.llm.mixing import mixed_documents
from corpusflow.llm.simhash import near_dedup
from corpusflow.llm.token_files import token_files
from corpusflow.llm.toxicity import drop_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression distance calls toxic go."""
    return drop_toxic(docs, table(spark, sf_dir, "labels"))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component stays (three-word shingles, at most two bits)."""
    return near_dedup(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Contaminated documents go."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixed_documents(docs)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files are written to the shared folder; a row for each document in them."""
    return token_files(docs)


STAGES = [
    ("toxicity", toxicity),
    ("simhash near-dedup", simhash_near_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("mixing", source_mixing),
    ("token output", token_output),
]

#: The first, second and last stage have no SQL form; the run is tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stored(docs, f"stage{k}")
    return docs
