"""Files by URI from inside tasks, for what Spark's readers can't do: reading by blocks, seeking, one file a row."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def file_system(uri: str):
    """(pyarrow file system, path) of a URI; Hadoop writes local ones with one slash after the scheme."""
    from pyarrow import fs

    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(uri)


def _write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    made = set()
    for batch in batches:
        for uri, content in zip(batch.column("path").to_pylist(), batch.column("content")):
            fs, path = file_system(uri)
            folder, _, name = path.rpartition("/")
            if folder not in made:
                fs.create_dir(folder, recursive=True)
                made.add(folder)
            part = f"{folder}/.{name}.{uuid.uuid4().hex}"
            data = content.as_buffer()
            with fs.open_output_stream(part, compression=None) as sink:
                sink.write(data)
            fs.move(part, path)
            yield pa.RecordBatch.from_pydict({"path": [uri], "length": pa.array([len(data)], pa.int64())})


def write_files(files: DataFrame) -> int:
    """Write ``files(path, content)``, one file a row (``path`` a full URI, unique), and return how many. A file appears whole
    under its name or not at all, so a task that runs again leaves the same files."""
    rows = files.select("path", F.col("content").cast("binary").alias("content"))
    return rows.mapInArrow(_write, "path string, length long").agg(F.count(F.lit(1))).first()[0]
