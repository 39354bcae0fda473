"""Config reader (both layouts), cached enrichment, slug cache, streaming ingest and folds."""

import json
import os

from corpusflow.operators import enrich as EN
from corpusflow.sources import config as CFG

CONFIG = {
    "domain_handlers": {"shelf.test": "shelf_handler", "example.org": "other"},
    "pages": [
        {"name": "Hill Library", "url": "https://books.example.org/php/hill_library.php", "language": "kn-IN", "process_flag": False, "limit": None},
        {"name": "Loose Leaves", "url": None, "language": "en-IN", "process_flag": True, "limit": 2,
         "books": [{"id": "Q001", "title_original": "Winter Tales", "author_original": "Ann Lee", "pdf_url": "https://shelf.test/details/x"},
                   {"id": "Q008", "title_original": "ಆನಂದ", "pdf_url": "https://shelf.test/download/y/y.pdf", "language": "kn-IN"}]},
        {"url": "https://host/php/x.php", "process_flag": True},
    ],
}


def test_read_config_both_layouts(spark, tmp_path):
    a = tmp_path / "config.json"
    a.write_text(json.dumps(CONFIG, indent=4, ensure_ascii=False), encoding="utf-8")
    b = tmp_path / "legacy.json"
    b.write_text(json.dumps(CONFIG["pages"], ensure_ascii=False), encoding="utf-8")
    for path, nhandlers in ((a, 2), (b, 0)):
        cfg = CFG.read_config(spark, str(path))
        h = cfg.select("handlers").collect()[0][0]
        assert len(h) == nhandlers
        pages = CFG.config_pages(cfg, keep=["config_path"])
        rows = pages.orderBy("page_pos").collect()
        assert [r.page_slug for r in rows] == ["hill_library", "loose-leaves", "x"]
        assert rows[2].page_name == "Unknown Page" and rows[2].page_language == "kn-IN"
        en = CFG.enabled_pages(pages)
        assert en.count() == 2
        books = CFG.inline_books(en).orderBy("book_pos").collect()
        assert [(b.id, b.author_original, b.book_language) for b in books] == [("Q001", "Ann Lee", None), ("Q008", "", "kn-IN")]
    h = CFG.read_config(spark, str(a)).select("handlers").collect()[0][0]
    assert [(x.pattern, x.module) for x in h] == [("shelf.test", "shelf_handler"), ("example.org", "other")]


def test_slug_cache_join(spark):
    from corpusflow.functions.text import ascii_fold

    items = spark.createDataFrame([("1", "Title", "Auth"), ("2", "T2", "A2"), ("3", "T3", "A3")], "id string, t string, a string")
    cache = spark.createDataFrame([("1", "c-t", "c-a"), ("2", "c-t2", "")], "id string, title_english_slug string, author_english_slug string")
    got = {r.id: (r.title_english_slug, r.author_english_slug, r.from_cache) for r in EN.slug_cache_join(items, cache, "id", ascii_fold("t"), ascii_fold("a")).collect()}
    assert got == {"1": ("c-t", "c-a", True), "2": ("t2", "a2", False), "3": ("t3", "a3", False)}
    assert sorted(r.id for r in EN.to_enrich(items, cache, "id").collect()) == ["2", "3"]


def test_enrich_cached_provider_and_fallback(spark, tmp_path):
    calls = []

    def provider(texts):
        calls.append(len(texts))
        return texts.map(lambda t: None if t.startswith("fail") else ("" if t.startswith("blank") else "Romanized " + t))

    df = spark.createDataFrame([(1, "ಕನ್ನಡ abc"), (2, "ಕನ್ನಡ abc"), (3, "fail ಕ x"), (4, ""), (5, None), (6, "blank x")], "k int, t string")
    out = {r.k: r.slug for r in EN.enrich_cached(df, "t", provider=provider, cache_out=str(tmp_path / "cache")).collect()}
    assert out[1] == out[2] == "romanized-ಕನನಡ-abc"
    assert out[3] == "fail-x"  # missing answer -> ascii fold
    assert out[6] == ""  # empty answer -> empty slug
    assert out[4] == "" and out[5] == ""  # empty or missing text -> ""
    cache = spark.read.parquet(str(tmp_path / "cache"))
    assert cache.count() == 3  # distinct texts with an answer; the failed one is asked again
    cache = cache.select("text", "slug")
    again = EN.enrich_cached(df, "t", provider=lambda s: (_ for _ in ()).throw(RuntimeError("must not be called")), cache=cache, cache_out=str(tmp_path / "cache2"))
    assert {r.k: r.slug for r in again.collect()} == out


def test_ingest_results(spark):
    res = spark.createDataFrame([("d1", 1, "Completed"), ("d1", 2, "Failed"), ("d2", 1, "Completed")], "doc string, part int, job_state string")
    per_doc, rejects = EN.ingest_results(res, "doc")
    assert {r.doc: r.accepted for r in per_doc.collect()} == {"d1": False, "d2": True}
    assert rejects.count() == 1


def test_incremental_upsert_rerun_is_noop(spark, tmp_path):
    from corpusflow.streaming.incremental import drain_drops, upsert_from_log

    drops, log, ckpt = (str(tmp_path / x) for x in ("drops", "log", "ckpt"))
    b1 = spark.createDataFrame([("p", "1", "u1"), ("p", "2", "u2")], "page_slug string, id string, pdf_url string")
    b1.write.parquet(os.path.join(drops, "d1"))
    schema = b1.schema
    drain_drops(spark, os.path.join(drops, "*"), schema, log, ckpt)
    b2 = spark.createDataFrame([("p", "2", "u2b"), ("p", "3", "u3")], schema)
    b2.write.parquet(os.path.join(drops, "d2"))
    drain_drops(spark, os.path.join(drops, "*"), schema, log, ckpt)
    n_log = spark.read.parquet(log).count()
    drain_drops(spark, os.path.join(drops, "*"), schema, log, ckpt)  # nothing new
    assert spark.read.parquet(log).count() == n_log == 4
    state = spark.createDataFrame([("p", "0", "u0", "completed")], "page_slug string, id string, pdf_url string, status string")
    final = {r.id: (r.pdf_url, r.status) for r in upsert_from_log(state, spark.read.parquet(log), ["_arrival", "_source"]).collect()}
    assert final == {"0": ("u0", "completed"), "1": ("u1", "pending"), "2": ("u2b", "pending"), "3": ("u3", "pending")}


def test_streaming_fold_matches_batch(spark, tmp_path):
    from corpusflow.streaming.fold import start_streaming_fold, state_fold

    src = str(tmp_path / "ev")
    ev = spark.createDataFrame([(1, 10, "a", 1), (1, 20, "b", 2), (2, 5, "c", 3), (1, 20, "z", 1)], "k int, ts int, v string, eid int")
    ev.write.parquet(src)
    stream = spark.readStream.schema(ev.schema).parquet(src)
    q = start_streaming_fold(stream, ["k"], "v", ["ts", "eid"], "memory", str(tmp_path / "ck"), queryName="fold_out")
    q.processAllAvailable()
    q.stop()
    got = {r.k: r.v for r in spark.sql("select * from fold_out").collect()}
    assert got == {r.k: r.v for r in state_fold(ev, ["k"], "v", ["ts", "eid"]).collect()} == {1: "b", 2: "c"}


def test_read_config_json_lines(spark, tmp_path):
    """One config document per line (each a legacy page list or a full config)."""
    p = tmp_path / "configs.jsonl"
    docs = [CONFIG["pages"][:1], {"domain_handlers": {"x.org": "m"}, "pages": CONFIG["pages"][1:2]}]
    p.write_text("\n".join(json.dumps(d, ensure_ascii=False) for d in docs) + "\n", encoding="utf-8")
    cfg = CFG.read_config(spark, str(p), lines=True)
    assert cfg.count() == 2
    pages = CFG.config_pages(cfg, keep=["config_path"]).collect()
    assert sorted(r.page_slug for r in pages) == ["hill_library", "loose-leaves"]
    assert sorted(len(r.handlers) for r in cfg.collect()) == [0, 1]


def test_enrich_reuses_its_own_folder_and_asks_failed_texts_one_by_one(spark, tmp_path):
    folder = str(tmp_path / "cache")

    def picky(texts):
        if any(t == "bad" for t in texts):
            raise RuntimeError("no")
        return texts.map(lambda t: "x " + t)

    df = spark.createDataFrame([(1, "a"), (2, "bad"), (3, "b")], "k int, t string").coalesce(1)
    first = {r.k: r.slug for r in EN.enrich_cached(df, "t", provider=picky, cache_out=folder, parallelism=1).collect()}
    assert first == {1: "x-a", 2: "bad", 3: "x-b"}
    cache = spark.read.parquet(folder).select("text", "slug")
    assert sorted(r.text for r in cache.collect()) == ["a", "b"]
    more = df.union(spark.createDataFrame([(4, "c")], "k int, t string"))
    again = EN.enrich_cached(more, "t", provider=picky, cache=cache, cache_out=folder).collect()
    assert sorted((r.k, r.slug) for r in again) == [(1, "x-a"), (2, "bad"), (3, "x-b"), (4, "x-c")]


def test_config_truth_and_errors(spark, tmp_path):
    import pytest

    pages = [{"name": n, "process_flag": f, "url": ""} for n, f in zip("abcdefgh", (1, 0, "x", "", [], [0], None, 0.0))] + [{"name": "i"}]
    p = tmp_path / "flags.json"
    p.write_text(json.dumps({"pages": pages}), encoding="utf-8")
    rows = CFG.config_pages(CFG.read_config(spark, str(p)), keep=["config_path"]).collect()
    assert [r.page_name for r in rows if r.process_flag] == ["a", "c", "f"]
    assert all(r.page_url is None and r.page_slug == r.page_name for r in rows)
    p.write_text(json.dumps({"pages": pages})[:-20], encoding="utf-8")
    with pytest.raises(Exception):
        CFG.config_pages(CFG.read_config(spark, str(p)), keep=["config_path"]).collect()


def test_later_drop_wins_within_one_drain(spark, tmp_path):
    import time

    from corpusflow.streaming.incremental import drain_drops, upsert_from_log

    drops, log, ckpt = (str(tmp_path / x) for x in ("drops", "log", "ckpt"))
    schema = "page_slug string, id string, pdf_url string"
    spark.createDataFrame([("p", "1", "old")], schema).write.parquet(os.path.join(drops, "drop=2"))
    time.sleep(1.1)
    new = spark.createDataFrame([("p", "1", "new")], schema)
    new.write.parquet(os.path.join(drops, "drop=10"))
    drain_drops(spark, os.path.join(drops, "*"), new.schema, log, ckpt)
    state = spark.createDataFrame([], schema + ", status string")
    assert [r.pdf_url for r in upsert_from_log(state, spark.read.parquet(log), ["_arrival", "_source"]).collect()] == ["new"]
