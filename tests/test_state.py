"""State operators: upsert, checksum verdicts, resets, limits, the stage machine, versions."""


from corpusflow.operators import state as ST
from corpusflow.schemas import BOOK_STATE, STATE_COLUMNS
from corpusflow.sources import state as SS


def _state(spark, rows):
    full = [tuple(r.get(c) for c in STATE_COLUMNS) for r in rows]
    return spark.createDataFrame(full, BOOK_STATE)


def test_upsert_keeps_old_values_and_nulls(spark):
    old = _state(spark, [
        {"page_slug": "p", "id": "1", "title_original": "Old", "pdf_url": "u1", "local_pdf_path": "a", "status": "completed", "title_english_slug": None},
        {"page_slug": "p", "id": "2", "title_original": "Keep", "pdf_url": "u2", "status": "failed"},
    ])
    new = spark.createDataFrame([("p", "1", "New", "n1", "b", "pending"), ("p", "3", "Fresh", "n3", "c", None)],
                                "page_slug string, id string, title_original string, pdf_url string, local_pdf_path string, status string")
    got = {r.id: r for r in ST.state_upsert(old, new).collect()}
    assert got["1"].title_original == "Old" and got["1"].pdf_url == "n1" and got["1"].local_pdf_path == "b"
    assert got["1"].status == "completed" and got["1"].title_english_slug is None
    assert got["2"].pdf_url == "u2" and got["2"].status == "failed"
    assert got["3"].title_original == "Fresh" and got["3"].status == "pending"


def test_upsert_idempotent(spark):
    old = _state(spark, [{"page_slug": "p", "id": "1", "pdf_url": "u", "status": "pending"}])
    new = spark.createDataFrame([("p", "1", "n")], "page_slug string, id string, pdf_url string")
    once = ST.state_upsert(old, new)
    twice = ST.state_upsert(once, new)
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))


def test_dedupe_batch_last_wins(spark):
    b = spark.createDataFrame([("p", "1", "a", 1), ("p", "1", "b", 2), ("p", "2", "c", 1)], "page_slug string, id string, pdf_url string, seq int")
    win, rej = ST.dedupe_batch(b, ["page_slug", "id"], "seq")
    assert {(r.id, r.pdf_url) for r in win.collect()} == {("1", "b"), ("2", "c")}
    assert [(r.id, r.pdf_url) for r in rej.collect()] == [("1", "a")]
    tie = spark.createDataFrame([("p", "1", "a", 1), ("p", "1", "b", 1), ("p", "1", "b", 1)], "page_slug string, id string, pdf_url string, seq int")
    win, rej = ST.dedupe_batch(tie, ["page_slug", "id"], "seq")
    assert [(r.id, r.pdf_url) for r in win.collect()] == [("1", "b")]
    assert sorted((r.id, r.pdf_url) for r in rej.collect()) == [("1", "a"), ("1", "b")]


def test_pending_keeps_null_status(spark):
    s = _state(spark, [{"page_slug": "p", "id": "1", "status": None}, {"page_slug": "p", "id": "2", "status": "completed"}])
    assert [r.id for r in ST.pending_books(s).collect()] == ["1"]


def test_checksum_verdicts(spark):
    df = spark.createDataFrame([(True, "h", "h"), (True, "h", None), (True, "h", "x"), (True, None, "h"), (False, None, "h")], "p boolean, cur string, rec string")
    got = [r[0] for r in df.select(ST.checksum_verdict("p", "cur", "rec")).collect()]
    assert got == ["verified", "adopted", "refetch", "refetch", "missing"]


def test_reset_statuses_and_counts(spark):
    s = _state(spark, [
        {"page_slug": "a", "id": "1", "status": "failed", "error_message": "boom", "ocr_status": "completed"},
        {"page_slug": "a", "id": "2", "status": "in_progress"},
        {"page_slug": "b", "id": "3", "status": "completed", "error_message": "old"},
        {"page_slug": "b", "id": "4", "status": None},
    ])
    r = {x.id: x for x in ST.reset_statuses(s).collect()}
    assert r["1"].status == "pending" and r["1"].ocr_status == "pending" and r["1"].error_message is None
    assert r["3"].status == "completed" and r["3"].error_message == "old"
    assert r["4"].status is None
    again = ST.reset_statuses(ST.reset_statuses(s))
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, ST.reset_statuses(s).collect()))
    counts = {x.page_slug: x.n_reset for x in ST.reset_counts(s).collect()}
    assert counts == {"a": 2, "b": 0}
    only_b = {x.id: x.status for x in ST.reset_statuses(s, target_page="b").collect()}
    assert only_b["1"] == "failed"


def test_limit_per_page(spark):
    ids = ["7", "A001", "999", "12", "-1", "100"]
    rows = [{"page_slug": p, "id": i, "status": "pending"} for p in ("none", "zero", "two") for i in ids]
    s = _state(spark, rows)
    limits = spark.createDataFrame([("none", None), ("zero", 0), ("two", 2)], "page_slug string, limit int")
    got = ST.limit_per_page(s, limits).collect()
    by = {}
    for r in got:
        by.setdefault(r.page_slug, []).append((r.ordinal, r.id, r.total))
    order = sorted(ids, key=lambda x: (x.zfill(3), x))
    assert sorted(by["none"]) == [(k + 1, i, 6) for k, i in enumerate(order)]
    assert sorted(by["zero"]) == [(k + 1, i, 6) for k, i in enumerate(order)]
    assert sorted(by["two"]) == [(1, order[0], 2), (2, order[1], 2)]


def test_stage_transition(spark):
    s = _state(spark, [
        {"page_slug": "p", "id": "dlfail", "status": "pending"},
        {"page_slug": "p", "id": "ocrfail", "status": "pending", "download_status": "completed"},
        {"page_slug": "p", "id": "convfail", "status": "failed"},
        {"page_slug": "p", "id": "ok", "status": "pending"},
        {"page_slug": "p", "id": "done", "status": "completed"},
        {"page_slug": "p", "id": "nodocxcopy", "status": "pending", "docx_conversion_status": "completed"},
    ])
    o = spark.createDataFrame([
        ("p", "dlfail", False, True, True, True, True),
        ("p", "ocrfail", False, False, True, True, True),
        ("p", "convfail", True, True, False, True, True),
        ("p", "ok", True, True, True, True, True),
        ("p", "done", False, False, False, False, False),
        ("p", "nodocxcopy", True, True, False, True, False),
    ], "page_slug string, id string, download_ok boolean, ocr_ok boolean, convert_ok boolean, md_copied boolean, docx_copied boolean")
    r = {x.id: x for x in ST.stage_transition(s, o).collect()}
    assert r["dlfail"].status == "failed" and r["dlfail"].download_status is None
    assert r["ocrfail"].status == "failed" and r["ocrfail"].download_status == "completed" and r["ocrfail"].ocr_status is None
    assert r["convfail"].status == "failed" and r["convfail"].docx_conversion_status is None and r["convfail"].ocr_status == "completed"
    assert (r["ok"].status, r["ok"].download_status, r["ok"].ocr_status, r["ok"].docx_conversion_status) == ("completed",) * 4
    assert r["done"].status == "completed" and r["done"].download_status is None
    assert r["nodocxcopy"].status == "pending"


def test_save_and_load_versions(spark, tmp_path):
    root = str(tmp_path / "state")
    assert SS.load_state(spark, root).count() == 0
    s = _state(spark, [{"page_slug": "p", "id": "1", "status": "pending"}])
    assert SS.save_state(s, root) == 1
    s2 = ST.reset_statuses(SS.load_state(spark, root))
    assert SS.save_state(s2, root) == 2
    assert SS.committed_versions(spark, root) == [1, 2]
    back = SS.load_state(spark, root).collect()
    assert [(r.page_slug, r.id, r.status) for r in back] == [("p", "1", "pending")]
    # a write that died midway: folder without _SUCCESS is skipped on read and not reused
    import os

    os.makedirs(os.path.join(root, "v=3"))
    assert SS.committed_versions(spark, root) == [1, 2]
    assert SS.save_state(s2, root) == 4
    assert SS.committed_versions(spark, root) == [1, 2, 4]


def test_load_reference_json_layout(spark, tmp_path):
    import json

    doc = {"books": [{"id": "A001", "title_original": "T", "status": "completed", "download_status": "completed"},
                     {"id": "A002", "title_original": "U", "error_message": "x"}]}
    p = tmp_path / "processing_state_assorted-books.json"
    p.write_text(json.dumps(doc, indent=4, ensure_ascii=False), encoding="utf-8")
    df = SS.load_state_json(spark, str(p), page_slug="assorted-books")
    rows = {r.id: r for r in df.collect()}
    assert rows["A001"].status == "completed" and rows["A002"].error_message == "x" and rows["A002"].status is None
    assert df.columns == STATE_COLUMNS


def test_upsert_is_one_join(spark):
    old = _state(spark, [{"page_slug": "p", "id": str(i), "pdf_url": f"u{i}", "status": "completed" if i % 2 else None} for i in range(50)])
    new = spark.createDataFrame([("p", str(i), f"n{i}") for i in range(40, 70)], "page_slug string, id string, pdf_url string")
    merged = ST.state_upsert(old, new)
    assert merged.count() == 70
    assert merged._jdf.queryExecution().executedPlan().toString().count("FullOuter") >= 1


def test_empty_slug_survives_a_round_trip(spark, tmp_path):
    """An empty slug is a key like any other: a re-scan finds the book again."""
    root = str(tmp_path / "state")
    SS.save_state(_state(spark, [{"page_slug": "", "id": "1", "status": "completed"}, {"page_slug": "p", "id": "1", "status": "failed"}]), root)
    new = spark.createDataFrame([("", "1", "n")], "page_slug string, id string, pdf_url string")
    got = sorted((r.page_slug, r.id, r.status) for r in ST.state_upsert(SS.load_state(spark, root), new).collect())
    assert got == [("", "1", "completed"), ("p", "1", "failed")]


def test_limits_of_pages_that_share_a_slug(spark):
    s = _state(spark, [{"page_slug": "p", "id": str(i), "status": "pending"} for i in range(3)])
    limits = spark.createDataFrame([("p", None, 1), ("p", 2, 0)], "page_slug string, limit int, page_pos int")
    first = ST.limit_per_page(s, limits, order=["page_pos"]).collect()
    assert sorted((r.id, r.ordinal, r.total) for r in first) == [("0", 1, 2), ("1", 2, 2)]
    assert ST.limit_per_page(s, limits).count() == 2  # without an order the least limit


def test_two_outcomes_of_one_book(spark):
    s = _state(spark, [{"page_slug": "p", "id": "1", "status": "pending"}])
    o = spark.createDataFrame([("p", "1", True, True, True, True, True), ("p", "1", True, False, True, True, True)],
                              "page_slug string, id string, download_ok boolean, ocr_ok boolean, convert_ok boolean, md_copied boolean, docx_copied boolean")
    got = ST.stage_transition(s, o).collect()
    assert [(r.status, r.download_status, r.ocr_status) for r in got] == [("failed", "completed", None)]


def test_recorded_hash_stays_until_a_download(spark):
    df = spark.createDataFrame([("verified", "h", "h"), ("adopted", "h", None), ("refetch", "h", "x"), ("missing", None, "x")], "v string, cur string, rec string")
    assert [r[0] for r in df.select(ST.hash_after_check("v", "cur", "rec")).collect()] == ["h", "h", "x", "x"]
