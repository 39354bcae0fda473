"""Upserts that rewrite touched pages only; merged texts in containers."""

import os

from pyspark.sql import functions as F

from corpusflow.operators.state import state_upsert
from corpusflow.sources import buckets as SB
from corpusflow.sources import state as SS


def _bytes(path):
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet"))


def _rows(df):
    return sorted(map(tuple, df.select("page_slug", "id", "pdf_url", "status").collect()), key=str)


def test_an_upsert_writes_what_it_touches(spark, tmp_path):
    root = str(tmp_path / "state")
    page = F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 997 == 1, F.lit(None)).when(F.col("id") % 997 == 2, F.lit("")).otherwise(F.concat(F.lit("p"), (F.col("id") % 300).cast("string")))
    state = spark.range(60_000).select(page.alias("page_slug"), F.col("id").cast("string").alias("id"), F.sha2(F.col("id").cast("string"), 256).alias("pdf_url"), F.lit("completed").alias("status"))
    assert SB.save_buckets(state, root, buckets=128) == 1
    assert _rows(SB.load_buckets(spark, root)) == _rows(state)
    batch = spark.createDataFrame([("p1", "1", "new"), ("p2", "x", "added"), (None, "1", "null page"), ("", None, "no id")], "page_slug string, id string, pdf_url string")
    before = current = SB.current_buckets(spark, root)
    version, touched = SB.upsert_pages(spark, root, batch)
    assert version == 2 and touched <= 4
    assert _bytes(f"{root}/v=2") < 0.1 * _bytes(f"{root}/v=1")
    want = _rows(state_upsert(SS.conform(state), batch))
    assert _rows(SB.load_buckets(spark, root)) == want
    current = SB.current_buckets(spark, root)
    assert sum(current[b] != before.get(b) for b in current) == touched
    plan = SB.load_buckets(spark, root, ["p1"])
    assert len(plan.inputFiles()) < 5 and {r["page_slug"] for r in plan.select("page_slug").collect()} == {"p1"}
    # a torn write: its folder is there, its _SUCCESS isn't
    SB.upsert_pages(spark, root, batch.withColumn("pdf_url", F.lit("torn")))
    os.remove(f"{root}/v=3/_SUCCESS")
    assert _rows(SB.load_buckets(spark, root)) == want
    assert SB.upsert_pages(spark, root, batch)[0] == 4 and _rows(SB.load_buckets(spark, root)) == want
    assert SB.upsert_pages(spark, str(tmp_path / "new"), batch)[0] == 1 and SB.load_buckets(spark, str(tmp_path / "new")).count() == 4


def test_container(spark, tmp_path):
    from corpusflow.sinks.container import read_container, read_document, write_container

    out = f"file:{tmp_path}/c"
    rows = [(f"d{d}", p, f"text {d} {p} é\n" * (d % 5)) for d in range(300) for p in range(d % 4)] + [("big", p, "x" * 1000) for p in range(400)] + [(None, 1, "n"), ("nulls", 2, "b"), ("nulls", None, None), ("same", 1, "s"), ("same", 1, "s")]
    df = spark.createDataFrame(rows, "doc string, part int, text string")
    write_container(df, "doc", "part", "text", out, sep="|", files=6)
    want = {}
    for d, p, t in sorted(rows, key=lambda r: (r[0] or "", r[1] is not None, r[1] or 0)):
        want[d or ""] = want.get(d or "", "") + (t or "") + "|"
    got = {r["doc"]: (r["n_parts"], r["merged_text"]) for r in read_container(spark, out).collect()}
    assert {d: t for d, (_, t) in got.items()} == want and got["big"][0] == 400
    assert len(list((tmp_path / "c" / "data").glob("*.bin"))) <= 6
    assert read_document(spark, out, "big") == want["big"] and read_document(spark, out, "nulls") == "|b|" and read_document(spark, out, "none") is None
    write_container(df.limit(0), "doc", "part", "text", f"{out}2")
    assert read_container(spark, f"{out}2").count() == 0
