"""K3 without a folder a document: merged texts in a few large files and an index of where each one is.

Rows are range-clustered by document and part and appended to one file a task; an index row gives a stretch of a file
that belongs to one document. A document that a range bound cuts has several stretches, ``seq`` in order. One document is read by
seeking; folders a document are an export (``sinks.text.write_merged``).
"""

from __future__ import annotations

import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusflow.operators.chunks import CHUNK_SEPARATOR
from corpusflow.sources.filesystem import file_system

INDEX = "doc string, seq long, file string, offset long, length long, parts long"


def write_container(texts: DataFrame, doc_col: str, part_col: str, text_col: str, out_dir: str, sep: str = CHUNK_SEPARATOR, files: int | None = None) -> None:
    """Write ``<out_dir>/data/*.bin`` and ``<out_dir>/index`` (Parquet): each document's texts in part order, each followed
    by ``sep``. A task's file has a name of its own, and only files in the index count, so lost and
    repeated tasks do no harm. A null text is empty; a null document is the document ''."""
    spark = texts.sparkSession
    n = files or int(spark.conf.get("spark.sql.shuffle.partitions"))
    after = sep.encode()
    folder = f"{out_dir.rstrip('/')}/data"

    def write(batches):
        from pyspark import TaskContext

        place = TaskContext.get().partitionId() << 32
        sink = open_ = None
        at = count = 0
        done: list[tuple] = []
        for batch in batches:
            for doc, text in zip(batch.column("doc").to_pylist(), batch.column("text").to_pylist()):
                if sink is None:
                    fs, base = file_system(folder)
                    fs.create_dir(base, recursive=True)
                    name = f"{uuid.uuid4().hex}.bin"
                    sink = fs.open_output_stream(f"{base}/{name}", compression=None)
                if open_ is None or open_[0] != doc:
                    if open_ is not None:
                        done.append((*open_, at - open_[3], count))
                    open_, count = (doc, place + len(done), f"{folder}/{name}", at), 0
                sink.write(text)
                sink.write(after)
                at += len(text) + len(after)
                count += 1
        if sink is not None:
            sink.close()
            done.append((*open_, at - open_[3], count))
        names = ["doc", "seq", "file", "offset", "length", "parts"]
        for k in range(0, len(done), 10_000):
            columns = [list(c) for c in zip(*done[k : k + 10_000])]
            yield pa.RecordBatch.from_pydict(dict(zip(names, columns)))

    doc = F.coalesce(F.col(doc_col).cast("string"), F.lit(""))
    rows = texts.select(doc.alias("doc"), F.col(part_col).alias("part"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"))
    ordered = rows.repartitionByRange(n, "doc", "part", F.xxhash64("text")).sortWithinPartitions("doc", "part", "text").select("doc", "text")
    ordered.mapInArrow(write, INDEX).write.mode("errorifexists").parquet(f"{out_dir.rstrip('/')}/index")


def read_document(spark: SparkSession, out_dir: str, doc: str) -> str | None:
    """One document, by its index rows (a pushed filter) and a seek each; None where there is none."""
    stretches = spark.read.schema(INDEX).parquet(f"{out_dir.rstrip('/')}/index").where(F.col("doc") == doc).orderBy("seq").collect()
    return b"".join(_stretch(r["file"], r["offset"], r["length"]) for r in stretches).decode() if stretches else None


def _stretch(file: str, offset: int, length: int) -> bytes:
    fs, path = file_system(file)
    with fs.open_input_file(path) as source:
        source.seek(offset)
        return source.read(length)


def read_container(spark: SparkSession, out_dir: str) -> DataFrame:
    """``(doc, n_parts, merged_text)`` of all documents. Only those that a bound cut are put together again."""

    def read(batches):
        for batch in batches:
            for r in batch.to_pylist():
                content = _stretch(r["file"], r["offset"], r["length"])
                yield pa.RecordBatch.from_arrays([pa.array([r["doc"]]), pa.array([r["seq"]], pa.int64()), pa.array([r["parts"]], pa.int64()), pa.array([content], pa.binary())], names=["doc", "seq", "parts", "content"])

    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    index = spark.read.schema(INDEX).parquet(f"{out_dir.rstrip('/')}/index").repartition(tasks, "file", "offset")
    stretches = index.mapInArrow(read, "doc string, seq long, parts long, content binary")
    parts = F.array_sort(F.collect_list(F.struct("seq", "content")))
    merged = F.aggregate(parts, F.lit(b""), lambda out, x: F.concat(out, x["content"]))
    return stretches.groupBy("doc").agg(F.sum("parts").alias("n_parts"), F.decode(merged, "UTF-8").alias("merged_text"))
