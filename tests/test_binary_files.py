"""Files one a row: writing, block digests, pre-check on structure, placeholders."""

import hashlib
import os

from pyspark.sql import functions as F


def _files(spark, rows, root):
    return spark.createDataFrame([(f"file:{root}/{n}", c) for n, c in rows], "path string, content binary")


def test_files_over_the_cell_limit(spark, tmp_path):
    from corpusflow.sources import files as FS
    from corpusflow.sources.filesystem import write_files

    sizes = [0, 1, 999, 1000, 1001, 5000, 300_000]
    rows = [(f"d{n % 3}/f{n}.bin", os.urandom(n)) for n in sizes]
    assert write_files(_files(spark, rows, tmp_path)) == len(rows)
    assert write_files(_files(spark, rows, tmp_path)) == len(rows)  # again: the same files
    assert sum(len(f) for _, _, f in os.walk(tmp_path)) == len(rows)
    want = {n.split("/")[1]: hashlib.sha256(c).hexdigest() for n, c in rows}
    old = spark.conf.get("spark.sql.sources.binaryFile.maxLength")
    spark.conf.set("spark.sql.sources.binaryFile.maxLength", "1000")  # a larger cell would fail the job
    try:
        got = FS.binary_digests(spark, str(tmp_path), "*.bin", cell_limit=1000).collect()
    finally:
        spark.conf.set("spark.sql.sources.binaryFile.maxLength", old)
    assert {r["path"].rsplit("/", 1)[1]: r["sha256"] for r in got} == want
    listed = spark.createDataFrame([(f"file:{tmp_path}/none.bin", 5), (f"file:{tmp_path}", 7), (f"file:{tmp_path}/{rows[4][0]}", 1001)], "path string, length long")
    block = {r["path"]: r["sha256"] for r in FS.streamed_digests(listed, block=64).collect()}
    assert sorted(map(str, block.values())) == sorted(["None", "None", want["f1001.bin"]])
    assert FS.streamed_digests(listed.limit(0)).count() == 0



def test_bytes_are_balanced(spark):
    from corpusflow.sources.files import balanced

    files = spark.createDataFrame([(f"f{i}", 1000 if i < 4 else 10 + i % 7) for i in range(200)], "path string, length long")
    bytes_ = [r["n"] for r in balanced(files, 4).groupBy(F.spark_partition_id()).agg(F.sum("length").alias("n")).collect()]
    assert len(bytes_) == 4 and max(bytes_) < 1.1 * min(bytes_)


def test_pdf_structure(spark):
    from corpusflow.operators.chunks import precheck_files

    def pdf(objects, header=b"%PDF-1.7\n", end=b"%%EOF", offset=None):
        body = header + b"".join(objects)
        at = len(body) if offset is None else offset
        return body + b"xref\n0 1\ntrailer <<>>\nstartxref\n" + str(at).encode() + b"\n" + end

    root = b"1 0 obj << /Type /Pages /Kids [2 0 R 3 0 R] /Count 12 >> endobj\n"
    child = b"2 0 obj << /Type/Pages /Parent 1 0 R /Count 5 >> endobj\n"
    page = b"3 0 obj << /Type /Page /Parent 1 0 R >> endobj\n"
    high = b"4 0 obj << >> stream\n" + bytes(range(256)) * 20 + b"\nendstream endobj\n"
    cases = [
        (pdf([child, root, page, high]), None, 12),
        (pdf([page, page, high]), None, 2),
        (pdf([high]), None, None),  # compressed page tree: a reader has to count
        (pdf([root], end=b"%%EO"), "Corrupted PDF file: EOF marker not found", 0),
        (b"", "Corrupted PDF file: Cannot read an empty file", 0),
        (pdf([root], header=b"%PDX"), "Corrupted PDF file: invalid pdf header", 0),
        (pdf([root], offset=10**7), "Corrupted PDF file: startxref points outside the cross-reference table", 0),
        (pdf([root]).replace(b"startxref", b"startxxxx"), "Corrupted PDF file: startxref not found", 0),
        (None, "PDF file not found.", 0),
    ]
    df = spark.createDataFrame([(i, c, None) for i, (c, _, _) in enumerate(cases)] + [(99, None, True)], "i int, content binary, locked boolean")
    got = {r["i"]: (r["precheck_error"], r["page_count"]) for r in precheck_files(df, out_of_reach="locked").collect()}
    assert got.pop(99) == ("Error reading PDF file: the file can't be read", 0)
    assert got == {i: (e, n) for i, (_, e, n) in enumerate(cases)}


def test_precheck_moves_no_contents(spark, tmp_path):
    """Only outcomes are joined to the expected files: contents go neither to the driver nor through an exchange."""
    import re

    import __spark_entry__ as E

    rows = [(i, f"text {i} " * 50, 100 * i) for i in range(12)] + [(0, "text 0 " * 50, 0)]
    spark.createDataFrame(rows, "doc_id long, text string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    df = E.queries()["precheck_files"](spark, str(tmp_path))
    errors = [None, "Corrupted PDF file: EOF marker not found", "Corrupted PDF file: Cannot read an empty file", "Corrupted PDF file: invalid pdf header", None, "PDF file not found."]
    want = [(i, errors[i % 6], n % 700 + 1 if i % 6 == 0 else 0) for i, _, n in rows]
    assert sorted(map(tuple, df.collect()), key=str) == sorted(want, key=str)
    plan = spark._jvm.org.apache.spark.sql.api.python.PythonSQLUtils.explainString(df.select("*")._jdf.queryExecution(), "formatted")
    moved = re.findall(r"^\(\d+\) \w*Exchange\n(?:Input|Output)[^\n]*", plan, re.M)
    assert moved and not any("content" in m for m in moved) and "Broadcast" not in plan


def test_placeholders_have_their_bytes(spark, tmp_path):
    from corpusflow.operators.chunks import failed_placeholder, skipped_placeholder
    from corpusflow.sinks.text import write_placeholders

    d = spark.createDataFrame([("a.pdf", "no such file", "a"), ("b c.pdf", "x\ny", "b")], "name string, error string, id string")
    d = d.select(F.concat(F.lit(f"file:{tmp_path}/"), "id", F.lit(".md")).alias("path"), F.when(F.col("id") == "a", failed_placeholder("name", "error")).otherwise(skipped_placeholder("name", "hosted")).alias("text"))
    assert write_placeholders(d, "path", "text") == 2
    assert (tmp_path / "a.md").read_text() == "# OCR Failed for a.pdf\n\nError: no such file\nThis is a placeholder Markdown file due to PDF pre-check failure."
    assert (tmp_path / "b.md").read_text() == "# OCR Skipped for b c.pdf\n\nThis is a placeholder Markdown file as hosted OCR was disabled for testing purposes."


def test_many_small_files(spark, tmp_path):
    """Tasks don't grow with the files; folders are listed at any depth, hidden names passed over, empty files kept."""
    from corpusflow.sources import files as FS

    want = {}
    for i in range(600):
        folder = tmp_path / str(i % 7) / ("deep" if i % 2 else ".")
        folder.mkdir(parents=True, exist_ok=True)
        (folder / f"{i}.{'md' if i % 3 else 'txt'}").write_bytes(b"x" * (i % 5))
        want[f"{i}.{'md' if i % 3 else 'txt'}"] = i % 5
    (tmp_path / "_hidden").mkdir()
    for name in ("_hidden/1.md", ".2.md", "_3.md", "4.md._COPYING_"):
        (tmp_path / name).write_bytes(b"no")
    read = FS.listed_files(spark, str(tmp_path), "*.md")
    assert read.rdd.getNumPartitions() <= int(spark.conf.get("spark.sql.shuffle.partitions"))
    got = {r["path"].rsplit("/", 1)[1]: (r["length"], len(r["content"])) for r in read.collect()}
    assert got == {k: (n, n) for k, n in want.items() if k.endswith(".md")}
    both = [r["path"] for r in FS.listed_files(spark, f"file://{tmp_path}", "*.{md,txt}").collect()]
    assert len(both) == len(set(both)) == 600 and all(p.startswith("file:/") and not p.startswith("file://") for p in both)
