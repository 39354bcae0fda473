"""Micro-batches folded into the state exactly once, and the keyed fold of a stream."""

import random

from pyspark.sql import functions as F

from corpusflow.schemas import BOOK_STATE
from corpusflow.sources import state as SS
from corpusflow.streaming import incremental as INC


def _drop(spark, path, rows):
    cols = ["page_slug", "id", "title_original", "pdf_url"]
    spark.createDataFrame(rows, "page_slug string, id string, title_original string, pdf_url string").select(cols).coalesce(1).write.parquet(path)


def _state(spark, root):
    return sorted(((r["page_slug"], r["id"], r["pdf_url"], r["status"]) for r in SS.load_state(spark, root).collect()), key=str)


def test_only_new_drops_are_read_and_replays_change_nothing(spark, tmp_path):
    root, drops, ckpt = (f"file:{tmp_path}/{n}" for n in ("state", "drops", "ckpt"))
    schema = "page_slug string, id string, title_original string, pdf_url string"
    _drop(spark, f"{drops}/drop=2", [("p", "1", "A", "u1"), ("p", None, "N", "n1"), ("q", "1", "B", "u2")])
    assert INC.apply_drops(spark, drops, schema, root, ckpt) == [3]
    _drop(spark, f"{drops}/drop=1", [("p", "1", "A2", "u1b"), ("p", None, "N", "n2"), ("q", "2", "C", "u3")])
    assert INC.apply_drops(spark, drops, schema, root, ckpt) == [3]  # the old drop isn't read again
    want = sorted([("p", "1", "u1b", "pending"), ("p", None, "n2", "pending"), ("q", "1", "u2", "pending"), ("q", "2", "u3", "pending")], key=str)
    assert _state(spark, root) == want
    assert INC.apply_drops(spark, drops, schema, root, ckpt) == []
    versions = SS.committed_versions(spark, root)
    (stream, last), = SS.load_ledger(spark, root).items()
    assert last == 1
    again = spark.createDataFrame([("p", "1", "X", "bad")], schema).withColumn("_arrival", F.current_timestamp()).withColumn("_source", F.lit(""))
    for batch in (0, 1):
        assert INC.apply_batch(again, batch, root, stream) is None
    assert INC.apply_batch(again.limit(0), 2, root, stream) is None
    assert SS.committed_versions(spark, root) == versions and _state(spark, root) == want
    # a ledger whose version was never committed doesn't count
    SS.save_ledger(spark, root, SS.next_version(spark, root), {stream: 7})
    assert SS.load_ledger(spark, root) == {stream: 1}
    # a batch job's version hands the ledger on
    SS.save_state(spark.createDataFrame([], BOOK_STATE), root, 50)
    assert SS.load_ledger(spark, root) == {stream: 1}


def test_a_write_that_died_is_done_again(spark, tmp_path):
    """The ledger was written, the version wasn't: the batch is folded when it comes again."""
    root = f"file:{tmp_path}/state"
    batch = spark.createDataFrame([("p", "1", "A", "u")], "page_slug string, id string, title_original string, pdf_url string").withColumn("_arrival", F.current_timestamp()).withColumn("_source", F.lit("f"))
    (tmp_path / "state" / "v=1").mkdir(parents=True)  # no _SUCCESS
    SS.save_ledger(spark, root, 1, {"s": 0})
    assert SS.load_ledger(spark, root) == {}
    assert INC.apply_batch(batch, 0, root, "s") == 2
    assert SS.load_ledger(spark, root) == {"s": 0} and _state(spark, root) == [("p", "1", "u", "pending")]


def test_keyed_fold_in_any_order(spark, tmp_path):
    from corpusflow.streaming.fold import drain_keyed_fold, state_fold

    rng = random.Random(2)
    rows = [(rng.choice(["a", "a", "a", "b", "c", None]), rng.randrange(40), i, rng.choice(["x", "y", None])) for i in range(400)]
    schema = "k string, ts long, n long, v string"
    for i in range(4):
        spark.createDataFrame(rows[i::4], schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass", None)
    drain_keyed_fold(stream, ["k"], "v", ["ts", "n"], f"{tmp_path}/log", f"{tmp_path}/ckpt")
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass", None) == before
    log = spark.read.parquet(f"{tmp_path}/log")
    got = {r["k"]: (r["ts"], r["n"], r["v"]) for r in state_fold(log.withColumn("r", F.struct("ts", "n", "v")), ["k"], "r", ["ts", "n"]).select("k", "r.*").collect()}
    want = {k: max(((t, n, v) for kk, t, n, v in rows if kk == k), key=lambda r: r[:2]) for k in {r[0] for r in rows}}
    assert got == want
    assert log.count() < len(rows)  # only changes


def test_keyed_fold_null_order(spark, tmp_path):
    """Updates without a time come first, as in the batch fold."""
    from corpusflow.streaming.fold import drain_keyed_fold, state_fold

    schema = "k string, ts long, n long, v string"
    drops = [[("a", None, 9, "x"), ("b", 1, 1, "y")], [("a", 3, 2, "z"), ("b", None, 5, "w"), ("c", None, 1, None), ("c", None, 2, "u")]]
    for rows in drops:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    drain_keyed_fold(stream, ["k"], "v", ["ts", "n"], f"{tmp_path}/log", f"{tmp_path}/ckpt")
    fold = lambda df: {tuple(r) for r in state_fold(df, ["k"], "v", ["ts", "n"]).collect()}
    assert fold(spark.read.parquet(f"{tmp_path}/log")) == fold(spark.read.parquet(f"{tmp_path}/in")) == {("a", "z"), ("b", "y"), ("c", "u")}
