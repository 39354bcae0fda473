"""S4 file listings, S5 file digests, S6 OCR result archives, S7 page metadata blocks."""

from __future__ import annotations

import fnmatch
import hashlib
import io
import os
import re
import zipfile

import pandas as pd
import pyarrow as pa
from pyarrow.fs import FileSelector, FileType
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusflow.functions.text import basename
from corpusflow.operators.ranking import number_within
from corpusflow.schemas import FILE_LISTING, PAGE_METADATA
from corpusflow.sources.filesystem import file_system

# --- fixed values --------------------------------------------------------------
MARKDOWN_SUFFIX = ".md"
METADATA_PREFIX = "metadata/"
METADATA_SUFFIX = ".json"
PAGE_FILE_PREFIX = "page_"
#: Bytes of a file that becomes one cell, and of a block of larger ones.
CELL_LIMIT = 64 << 20
BLOCK = 4 << 20
#: Names of a folder that are handed on at once.
LISTED = 10_000
# the parser's column for documents that don't fit
CORRUPT = "_malformed"
# -------------------------------------------------------------------------------


def _malformed(parsed: Column) -> Column:
    """Whether a document parsed with ``CORRUPT`` in its schema is no such document."""
    return parsed.isNull() | parsed[CORRUPT].isNotNull()


def _parse(text: Column, schema: T.StructType) -> Column:
    return F.from_json(text, T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())]), {"columnNameOfCorruptRecord": CORRUPT})


def _file_columns() -> list[Column]:
    size = F.col("_f.size")
    return [F.col("pos"), F.coalesce(F.col("_f.name"), F.lit("")).alias("name"), F.try_variant_get(size, "$", "string").alias("size"), F.to_json(size).alias("size_json")]


def file_listing(items: DataFrame, json_col: str, keep: list[str]) -> DataFrame:
    """Item metadata JSON -> one row per file (``pos`` 0-based, listing order): name,
    size as text, and ``size_json``, the size as it stands in the document (null: no such
    key). Items without ``files`` and malformed metadata give no rows (see
    :func:`metadata_errors`); a file without ``name`` gets ''."""
    parsed = items.select(*keep, _parse(F.col(json_col), FILE_LISTING).getField("files").alias("_files"))
    return parsed.select(*keep, F.posexplode("_files").alias("pos", "_f")).select(*keep, *_file_columns())


def metadata_errors(items: DataFrame, json_col: str, keep: list[str]) -> DataFrame:
    """Items whose metadata couldn't be fetched (null), isn't such a document, or has a null where the
    listing or a file's name should be, with a reason."""
    parsed = items.select(*keep, F.col(json_col).alias("_text"), _parse(F.col(json_col), FILE_LISTING).alias("_parsed"))
    return parsed.select(*keep, _reason(F.col("_text"), F.col("_parsed")).alias("reason")).where(F.col("reason").isNotNull())


def file_listing_with_errors(items: DataFrame, json_col: str, keep: list[str]) -> DataFrame:
    """:func:`file_listing` and :func:`metadata_errors` in one pass, each document parsed once: rows have a ``reason`` too, an item
    that has one gives one row without ``pos`` instead of its files."""
    parsed = items.select(*keep, F.col(json_col).alias("_text"), _parse(F.col(json_col), FILE_LISTING).alias("_parsed"))
    known = parsed.select(*keep, F.col("_parsed.files").alias("_files"), _reason(F.col("_text"), F.col("_parsed")).alias("reason"))
    files = known.select(*keep, "reason", F.posexplode_outer(F.when(F.col("reason").isNull(), F.col("_files"))).alias("pos", "_f"))
    return files.where("pos is not null or reason is not null").select(*keep, *_file_columns(), "reason")


def _reason(c: Column, parsed: Column) -> Column:
    """Why a document (``c``, parsed by :func:`_parse`) has no listing, or null. Only one whose listing or a name of it is null
    after parsing is looked at as a variant, to tell a null from a key that isn't there."""
    doc = F.try_parse_json(c)
    files = F.try_variant_get(doc, "$.files", "variant")
    is_null = lambda v: F.coalesce(F.to_json(v) == "null", F.lit(False))
    nameless = F.exists(F.try_variant_get(doc, "$.files", "array<variant>"), lambda f: is_null(F.try_variant_get(f, "$.name", "variant")))
    unnamed = F.coalesce(F.exists(parsed["files"], lambda f: f["name"].isNull()), F.lit(False))
    return (
        F.when(c.isNull(), F.lit("metadata is missing"))
        .when(_malformed(parsed), F.lit("metadata is malformed"))
        .when(parsed["files"].isNull(), F.when(is_null(files), F.lit("file listing is null")))
        .when(unnamed, F.when(F.coalesce(nameless, F.lit(False)), F.lit("file name is null")))
    )


def binary_digests(spark: SparkSession, path: str, glob: str = "*", cell_limit: int = CELL_LIMIT) -> DataFrame:
    """S5 scan: ``path, length, sha256`` of every readable file under ``path``. Files up to ``cell_limit`` are read as
    cells and digested by Spark, larger ones by blocks. Unreadable or vanished files are skipped or get a
    null digest, so the expected-list join gives null for them."""
    found = file_list(spark, path, glob)
    small = with_content(found.where(F.col("length") <= cell_limit)).select("path", "length", F.sha2(F.col("content"), 256).alias("sha256"))
    return small.unionByName(streamed_digests(found.where(F.col("length") > cell_limit)))


def listed_files(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """``path, length, content`` of the files under ``path`` that can be read, empty ones too."""
    return with_content(file_list(spark, path, glob))


def _names(glob: str) -> list[str]:
    """A glob's alternatives: ``{a,b}`` spelled out."""
    found = re.search(r"\{([^{}]*)\}", glob)
    if not found:
        return [glob.replace("[^", "[!")]
    return [n for part in found[1].split(",") for n in _names(glob[: found.start()] + part + glob[found.end() :])]


def _hidden(name: str) -> bool:
    """Whether Spark's readers pass over a file or folder of this name."""
    if name.startswith(("_metadata", "_common_metadata")):
        return False
    return name.startswith(".") or (name.startswith("_") and "=" not in name) or name.endswith("._COPYING_")


def file_list(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """``path, length`` of the files below the folder ``path`` whose names match, but for hidden ones, with their paths as
    Spark's readers write them. Folders are listed by tasks, level by level, and the list is kept as a table: the
    driver never holds it."""
    from corpusflow.session import scratch

    if not re.match("^[A-Za-z][A-Za-z0-9+.-]*:", path):
        store = spark.sparkContext._jsc.hadoopConfiguration().get("fs.defaultFS") or "file:/"
        path = "file:" + os.path.abspath(path) if store.startswith("file:") else store.rstrip("/") + path
    names = _names(glob)

    def level(batches):
        for batch in batches:
            for folder in batch.column("path").to_pylist():
                fs, own = file_system(folder)
                rows = []
                for info in fs.get_file_info(FileSelector(own)):
                    name = info.base_name
                    inner = info.type == FileType.Directory
                    if not _hidden(name) and (inner or any(fnmatch.fnmatchcase(name, n) for n in names)):
                        rows.append((f"{folder}/{name}", info.size or 0, inner))
                for k in range(0, len(rows), LISTED):
                    paths, sizes, inner = zip(*rows[k : k + LISTED])
                    yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(sizes, pa.int64()), pa.array(inner, pa.bool_())], names=["path", "length", "folder"])

    root = scratch(spark, "listing")
    todo = spark.createDataFrame([(re.sub("^file:/+", "file:/", path).rstrip("/"),)], "path string")
    parts, depth = int(spark.conf.get("spark.sql.shuffle.partitions")), 0
    listing = None
    while depth == 0 or not todo.isEmpty():
        todo.repartition(parts if depth else 1, "path").mapInArrow(level, "path string, length long, folder boolean").write.parquet(f"{root}/{depth}")
        found = spark.read.schema("path string, length long, folder boolean").parquet(f"{root}/{depth}")
        listing = found if listing is None else listing.union(found)
        todo = found.where("folder").select("path")
        depth += 1
    return listing.where("not folder").select("path", "length")


def with_content(files: DataFrame) -> DataFrame:
    """``path, length, content`` of ``files(path, length)``; files that are gone or can't be read are left out. Files are
    dealt by number, so that many small ones don't make as many tasks; a task holds a few at a time."""

    def read(batches):
        def batch_of(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.string(), pa.int64(), pa.binary()))], names=["path", "length", "content"])

        for batch in batches:
            rows, held = [], 0
            for path, length in zip(batch.column("path").to_pylist(), batch.column("length").to_pylist()):
                data = b""
                if length:
                    try:
                        fs, own = file_system(path)
                        with fs.open_input_stream(own, compression=None) as source:
                            data = source.read()
                    except OSError:
                        continue
                rows.append((path, length, data))
                held += len(data)
                if held >= BLOCK:
                    yield batch_of(rows)
                    rows, held = [], 0
            if rows:
                yield batch_of(rows)

    n = int(files.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return files.select("path", "length").repartition(n, "path").mapInArrow(read, "path string, length long, content binary")


def balanced(files: DataFrame, tasks: int) -> DataFrame:
    """``files(path, length)`` dealt to ``tasks`` partitions of about equal bytes: largest first, forth and back."""
    order = [-F.col("length"), F.col("path")]
    numbered = number_within(files.select("path", "length"), [], order, out="_n")
    turn = (F.col("_n") - 1) % (2 * tasks)
    task = F.when(turn < tasks, turn).otherwise(2 * tasks - 1 - turn)
    return numbered.repartitionById(tasks, task.cast("int")).drop("_n")


def streamed_digests(files: DataFrame, block: int = BLOCK, tasks: int | None = None) -> DataFrame:
    """S5 by block reads: ``path, length, sha256`` of ``files(path, length)``, whatever their size; a task holds
    one block. A file that is absent or can't be read gets a null digest."""

    def digests(batches):
        for batch in batches:
            out = []
            for path in batch.column("path").to_pylist():
                try:
                    fs, own = file_system(path)
                    state = hashlib.sha256()
                    with fs.open_input_stream(own, compression=None) as source:
                        while data := source.read(block):
                            state.update(data)
                    out.append(state.hexdigest())
                except OSError:
                    out.append(None)
            yield pa.RecordBatch.from_arrays([batch.column("path"), batch.column("length"), pa.array(out, pa.string())], names=["path", "length", "sha256"])

    n = tasks or int(files.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return balanced(files, n).mapInArrow(digests, "path string, length long, sha256 string")


def expected_digests(expected: DataFrame, path_col: str, scan: DataFrame) -> DataFrame:
    """Expected file list left-joined to the scan; an absent file gives a null digest."""
    s = scan.select(F.col("path").alias("_scan_path"), F.col("sha256"))
    return expected.join(s, expected[path_col] == s["_scan_path"], "left").drop("_scan_path")


def _unpack(batches):
    """One frame per archive, so that a task holds one archive's texts at a time."""
    columns = ["archive_path", "entry_pos", "entry_name", "content", "error"]
    for pdf in batches:
        for path, content in zip(pdf["path"], pdf["content"]):
            rows = []
            try:
                with zipfile.ZipFile(io.BytesIO(content)) as z:
                    for pos, info in enumerate(z.infolist()):
                        name = info.filename
                        if name.endswith(MARKDOWN_SUFFIX) or (name.startswith(METADATA_PREFIX) and name.endswith(METADATA_SUFFIX)):
                            rows.append((path, pos, name, z.read(info).decode("utf-8"), None))
            except Exception as e:  # a damaged archive gives one error row and nothing else
                rows = [(path, -1, None, None, f"{type(e).__name__}: {e}")]
            yield pd.DataFrame(rows, columns=columns)


def unpack_archives(archives: DataFrame) -> DataFrame:
    """The markdown and page-metadata entries of every archive in a ``path, content``
    DataFrame (the binaryFile layout), in archive order; other entries aren't read. All or
    nothing: an archive of which a needed entry can't be read, or isn't UTF-8, gives one row
    with its ``error``. An archive without such entries gives no row."""
    return archives.select("path", "content").mapInPandas(
        _unpack, "archive_path string, entry_pos int, entry_name string, content string, error string"
    )


def archive_entries(spark: SparkSession, path: str, glob: str = "*.zip") -> DataFrame:
    """S6 scan: every entry of every result archive under ``path``."""
    raw = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(path)
    return unpack_archives(raw)


def ocr_outputs(entries: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Per archive the first ``.md`` entry in archive order, plus all ``metadata/*.json``
    entries. Archives without a markdown entry come back with a null ``markdown`` (failed)."""
    is_md = F.col("entry_name").endswith(MARKDOWN_SUFFIX)
    docs = entries.groupBy("archive_path").agg(
        F.min_by(F.col("content"), F.when(is_md, F.col("entry_pos"))).alias("markdown"),
        F.min_by(F.col("entry_name"), F.when(is_md, F.col("entry_pos"))).alias("markdown_entry"),
    )
    meta = entries.filter(
        F.col("entry_name").startswith(METADATA_PREFIX) & F.col("entry_name").endswith(METADATA_SUFFIX)
    ).select("archive_path", "entry_pos", basename("entry_name").alias("file_name"), "content")
    return docs, meta


def page_num_from_name(file_name) -> Column:
    c = F.col(file_name) if isinstance(file_name, str) else file_name
    stripped = F.replace(F.replace(c, F.lit(PAGE_FILE_PREFIX), F.lit("")), F.lit(METADATA_SUFFIX), F.lit(""))
    return stripped.try_cast("int")


def block_rows(pages: DataFrame, json_col: str, file_name_col: str, keep: list[str]) -> DataFrame:
    """Page metadata JSON -> one row per block that has a confidence.
    page_num from the document (a number or its text), else from the file name (``page_`` and
    ``.json`` removed). Malformed pages give no rows (see :func:`block_rejects`)."""
    parsed = pages.select(*keep, file_name_col, _parse(F.col(json_col), PAGE_METADATA).alias("_p"))
    with_page = parsed.select(
        *keep,
        file_name_col,
        F.coalesce(F.col("_p.page_num").try_cast("int"), page_num_from_name(F.col(file_name_col))).alias("page_num"),
        F.col("_p.blocks").alias("_blocks"),
    )
    ex = with_page.select(*keep, file_name_col, "page_num", F.posexplode("_blocks").alias("block_pos", "_b"))
    return ex.filter(F.col("_b.confidence").isNotNull()).select(
        *keep,
        file_name_col,
        "page_num",
        "block_pos",
        F.col("_b.block_id").alias("block_id"),
        F.col("_b.confidence").alias("confidence"),
        F.coalesce(F.col("_b.text"), F.lit("")).alias("text"),
    )


def block_rejects(pages: DataFrame, json_col: str, file_name_col: str, keep: list[str]) -> DataFrame:
    """Page metadata documents that are missing or malformed, with a reason."""
    c = F.col(json_col)
    reason = F.when(c.isNull(), F.lit("page metadata is missing")).otherwise(F.lit("page metadata is malformed"))
    return pages.where(c.isNull() | _malformed(_parse(c, PAGE_METADATA))).select(*keep, file_name_col, reason.alias("reason"))
