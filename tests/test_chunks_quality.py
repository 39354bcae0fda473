"""Chunk planning / re-assembly and OCR quality metrics."""

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from corpusflow.operators import chunks as CH
from corpusflow.operators import quality as Q
from corpusflow.sources import files as FS


def test_chunk_plan_edges(spark):
    df = spark.createDataFrame([(1, 0), (2, 500), (3, 501), (4, 1500), (5, 1501)], "doc int, n int")
    rows = CH.chunk_plan(df, "n").orderBy("doc", "part").collect()
    got = [(r.doc, r.part, r.start_page, r.end_page) for r in rows]
    assert [r.n_parts for r in rows] == [1, 1, 2, 2, 3, 3, 3, 4, 4, 4, 4]
    assert got == [
        (1, None, 0, 0), (2, None, 0, 500),
        (3, 1, 0, 500), (3, 2, 500, 501),
        (4, 1, 0, 500), (4, 2, 500, 1000), (4, 3, 1000, 1500),
        (5, 1, 0, 500), (5, 2, 500, 1000), (5, 3, 1000, 1500), (5, 4, 1500, 1501),
    ]


@settings(max_examples=10, deadline=None)
@given(st.lists(st.text(max_size=1800), min_size=1, max_size=8))
def test_slices_round_trip(spark, texts):
    """C3 then A3 (minus separators) gives the text back; ranges tile [0, n)."""
    df = spark.createDataFrame([(i, t, len(t)) for i, t in enumerate(texts)], "doc int, text string, n int")
    plan = CH.chunk_plan(df, "n")
    sl = CH.chunk_slices(plan, "text").withColumn("part", F.coalesce("part", F.lit(1)))
    merged = CH.ordered_merge(sl, "doc", "part", "slice", sep="").orderBy("doc").collect()
    assert [m.merged_text for m in merged] == texts


def test_ordered_merge_separator_after_each_part(spark):
    df = spark.createDataFrame([(1, 2, "b"), (1, 1, "a"), (2, 1, "c")], "doc int, part int, t string")
    got = {r.doc: r.merged_text for r in CH.ordered_merge(df, "doc", "part", "t").collect()}
    sep = "\n\n---\n\n"
    assert got == {1: "a" + sep + "b" + sep, 2: "c" + sep}


def test_all_or_nothing(spark):
    plan = spark.createDataFrame([(1, 1), (1, 2), (2, 1)], "doc int, part int")
    texts = spark.createDataFrame([(1, 1), (1, 2), (2, 1)], "doc int, part int")
    metas = spark.createDataFrame([(1, 1), (2, 1)], "doc int, part int")
    co = CH.chunk_outputs(plan, texts, metas, ["doc", "part"])
    ok = {r.doc: r.success for r in CH.document_success(co, "doc").collect()}
    assert ok == {1: False, 2: True}


def test_precheck_and_placeholder(spark):
    df = spark.createDataFrame([(False, None, False), (True, "bad xref", True), (True, "io", False), (True, None, False)], "present boolean, err string, corrupt boolean")
    got = [r[0] for r in df.select(CH.precheck_error("present", "err", "corrupt")).collect()]
    assert got == ["PDF file not found.", "Corrupted PDF file: bad xref", "Error reading PDF file: io", None]
    ph = spark.createDataFrame([("x.pdf", "PDF file not found.")], "f string, e string").select(CH.failed_placeholder("f", "e")).collect()[0][0]
    assert ph == "# OCR Failed for x.pdf\n\nError: PDF file not found.\nThis is a placeholder Markdown file due to PDF pre-check failure."


def _pages(spark):
    import json

    rows = [
        ("d1", 1, "page_1.json", json.dumps({"page_num": 1, "blocks": [{"block_id": "a", "confidence": 0.7, "text": "t"}, {"block_id": "b", "confidence": 0.2}]})),
        ("d1", 1, "page_2.json", json.dumps({"blocks": [{"block_id": "c"}, {"block_id": "d", "confidence": 0.5}]})),
        ("d1", 2, "page_2.json", json.dumps({"page_num": 7, "blocks": []})),
        ("d2", 1, "page_3.json", json.dumps({"page_num": 3})),
    ]
    return spark.createDataFrame(rows, "doc string, part int, file_name string, metadata string")


def test_blocks_and_metrics_edge_cases(spark):
    blocks = FS.block_rows(_pages(spark), "metadata", "file_name", ["doc", "part"])
    got = sorted((r.doc, r.page_num, r.block_id, r.confidence) for r in blocks.collect())
    assert got == [("d1", 1, "a", 0.7), ("d1", 1, "b", 0.2), ("d1", 2, "d", 0.5)]
    docs = spark.createDataFrame([("d1",), ("d2",), ("d3",)], "doc string")
    m = {r.doc: r for r in Q.confidence_metrics(blocks, docs, "doc").collect()}
    assert abs(m["d1"].avg_page_confidence - (0.7 + 0.2 + 0.5) / 3) < 1e-12
    assert m["d1"].low_confidence_blocks_count == 2  # 0.7 is not below 0.7
    assert m["d1"].pages_with_low_confidence_blocks == [1, 2]
    assert (m["d2"].avg_page_confidence, m["d2"].low_confidence_blocks_count, m["d2"].pages_with_low_confidence_blocks) == (None, 0, [])
    assert m["d3"].low_confidence_blocks_count == 0


def test_metadata_union_keeps_same_file_name_in_two_parts(spark):
    p = _pages(spark)
    u = Q.merge_metadata([p.filter("part = 1"), p.filter("part = 2")])
    assert u.filter("doc = 'd1' and file_name = 'page_2.json'").count() == 2
    ranks = sorted((r.part, r.file_name, r.file_rank) for r in Q.sort_metadata(u.filter("doc='d1'"), "doc", "file_name", tie=["part"]).collect())
    assert ranks == [(1, "page_1.json", 1), (1, "page_2.json", 2), (2, "page_2.json", 3)]


def test_write_merged_bytes_equal_ordered_merge(spark, tmp_path):
    import glob
    import os

    from corpusflow.sinks.text import write_merged

    df = spark.createDataFrame([(1, 2, "second\nline"), (1, 1, "first"), (2, 1, "only"), (1, 3, "")], "doc int, part int, t string")
    out = str(tmp_path / "md")
    write_merged(df, "doc", "part", "t", out)
    expected = {r.doc: r.merged_text for r in CH.ordered_merge(df, "doc", "part", "t").collect()}
    for doc, text in expected.items():
        files = [f for f in glob.glob(os.path.join(out, f"doc={doc}", "part-*")) if os.path.getsize(f) > 0]
        assert len(files) == 1
        assert open(files[0], encoding="utf-8").read() == text


def test_skipped_placeholder_and_fetch_hash(spark):
    from corpusflow.operators.state import hash_after_fetch

    ph = spark.createDataFrame([("x.pdf",)], "f string").select(CH.skipped_placeholder("f", "the")).collect()[0][0]
    assert ph == "# OCR Skipped for x.pdf\n\nThis is a placeholder Markdown file as the OCR was disabled for testing purposes."
    df = spark.createDataFrame([("new", "old"), (None, "old")], "n string, o string")
    assert [r[0] for r in df.select(hash_after_fetch("n", "o")).collect()] == ["new", "old"]
