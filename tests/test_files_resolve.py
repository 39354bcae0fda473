"""Binary digests, OCR archives, file listings, best-file choice and URL resolution."""

import hashlib
import io
import json
import zipfile

from pyspark.sql import functions as F

from corpusflow.operators import resolve as RS
from corpusflow.sources import files as FS


def test_binary_digests_match_hashlib(spark, tmp_path):
    d = tmp_path / "pdfs"
    d.mkdir()
    blobs = {"a.pdf": b"%PDF-1.4 hello", "b.pdf": bytes(range(256)) * 100}
    for n, b in blobs.items():
        (d / n).write_bytes(b)
    scan = FS.binary_digests(spark, str(d), "*.pdf")
    got = {r.path.rsplit("/", 1)[-1]: r.sha256 for r in scan.collect()}
    assert got == {n: hashlib.sha256(b).hexdigest() for n, b in blobs.items()}
    exp = spark.createDataFrame([("file:" + str(d / "a.pdf"),), ("file:" + str(d / "missing.pdf"),)], "p string")
    res = {r.p.rsplit("/", 1)[-1]: r.sha256 for r in FS.expected_digests(exp, "p", scan).collect()}
    assert res == {"a.pdf": hashlib.sha256(blobs["a.pdf"]).hexdigest(), "missing.pdf": None}


def _zip(entries):
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as z:
        for name, data in entries:
            z.writestr(name, data)
    return buf.getvalue()


def test_ocr_archive_unpack(spark, tmp_path):
    d = tmp_path / "out"
    d.mkdir()
    (d / "job1.zip").write_bytes(_zip([("readme.txt", "x"), ("doc.md", "# first"), ("other.md", "# second"), ("metadata/page_1.json", "{}"), ("metadata/x.txt", "no")]))
    (d / "job2.zip").write_bytes(_zip([("metadata/page_2.json", "{}")]))
    (d / "bad.zip").write_bytes(b"not a zip")
    entries = FS.archive_entries(spark, str(d))
    docs, meta = FS.ocr_outputs(entries.filter(F.col("error").isNull()))
    md = {r.archive_path.rsplit("/", 1)[-1]: r.markdown for r in docs.collect()}
    assert md == {"job1.zip": "# first", "job2.zip": None}
    assert {r.entry_name for r in entries.collect()} == {None, "doc.md", "other.md", "metadata/page_1.json", "metadata/page_2.json"}
    assert sorted((r.archive_path.rsplit("/", 1)[-1], r.file_name) for r in meta.collect()) == [("job1.zip", "page_1.json"), ("job2.zip", "page_2.json")]
    assert entries.filter(F.col("error").isNotNull()).count() == 1


def _listing(spark, items):
    rows = [(k, json.dumps({"files": files}) if files is not None else "{}") for k, files in items.items()]
    return FS.file_listing(spark.createDataFrame(rows, "item_id string, metadata string"), "metadata", ["item_id"])


def test_best_file_rules(spark):
    items = {
        "only_text": [{"name": "a_text.pdf", "size": "5"}, {"name": "b_text.pdf", "size": "9"}],
        "equal": [{"name": "x.pdf", "size": "3"}, {"name": "y.pdf", "size": "3"}, {"name": "z_text.pdf", "size": "99"}],
        "missing_size": [{"name": "m.pdf"}, {"name": "n.PDF", "size": "1"}],
        "bad_size": [{"name": "p.pdf", "size": "abc"}, {"name": "q.pdf", "size": "7"}],
        "bad_text_only": [{"name": "ok.pdf", "size": "1"}, {"name": "t_text.pdf", "size": "abc"}],
        "no_pdf": [{"name": "r.txt", "size": "1"}],
        "no_files": None,
    }
    best = {r.item_id: (r.best_name, r.size_error) for r in RS.best_file(_listing(spark, items)).collect()}
    assert best == {
        "only_text": ("b_text.pdf", False),
        "equal": ("x.pdf", False),
        "missing_size": ("n.PDF", False),
        "bad_size": (None, True),
        "bad_text_only": ("ok.pdf", False),
    }


def test_resolved_url_fallbacks(spark):
    items = {"good": [{"name": "Book One.pdf", "size": "2"}], "err": [{"name": "e.pdf", "size": "x1"}], "nopdf": [{"name": "a.txt"}]}
    best = RS.best_file(_listing(spark, items))
    cat = spark.createDataFrame(
        [("https://shelf.test/details/good/page/n1",), ("https://shelf.test/details/err",), ("https://shelf.test/details/nopdf",), ("https://shelf.test/download/z/z.pdf",)],
        "url string",
    )
    got = {r.url: r.resolved_url for r in RS.resolved_urls(cat, "url", best, "item_id", "https://shelf.test/download").collect()}
    assert got == {
        "https://shelf.test/details/good/page/n1": "https://shelf.test/download/good/Book%20One.pdf",
        "https://shelf.test/details/err": "https://shelf.test/download/err/err.pdf",
        "https://shelf.test/details/nopdf": "https://shelf.test/details/nopdf",
        "https://shelf.test/download/z/z.pdf": "https://shelf.test/download/z/z.pdf",
    }


def test_handler_first_match_in_config_order(spark):
    handlers = [("shelf.test", "shelf_handler"), ("org", "generic")]
    df = spark.createDataFrame([("https://www.shelf.test/x",), ("https://x.org/y",), ("https://x.com/y",), ("https://u:p@shelf.test:8080/z",)], "u string")
    got = [r[0] for r in df.select(RS.match_handler("u", handlers)).collect()]
    assert got == ["shelf_handler", "generic", None, "shelf_handler"]
    reg = RS.HandlerRegistry().register("shelf_handler", lambda d, c: d.withColumn("resolved_url", F.lit(None).cast("string")))
    out = {r.u: r.resolved_url for r in reg.dispatch(df, "u", handlers).collect()}
    assert out["https://www.shelf.test/x"] == "https://www.shelf.test/x"  # null answer -> original
    assert out["https://x.org/y"] == "https://x.org/y"  # unregistered module -> original
    both = (
        RS.HandlerRegistry()
        .register_column("generic", lambda u: F.concat(u, F.lit("?resolved")))
        .register("shelf_handler", lambda d, c: d.withColumn("resolved_url", F.regexp_replace(F.col(c), "/x$", "/y")))
    )
    out2 = {r.u: (r.handler, r.resolved_url) for r in both.dispatch(df, "u", handlers).collect()}
    assert out2 == {
        "https://www.shelf.test/x": ("shelf_handler", "https://www.shelf.test/y"),
        "https://x.org/y": ("generic", "https://x.org/y?resolved"),
        "https://x.com/y": (None, "https://x.com/y"),
        "https://u:p@shelf.test:8080/z": ("shelf_handler", "https://u:p@shelf.test:8080/z"),
    }


def test_handler_from_config_column(spark):
    df = spark.createDataFrame(
        [("https://www.shelf.test/x", [("shelf.test", "a"), ("org", "b")]), ("https://x.org/y", [("shelf.test", "a"), ("org", "b")]), ("https://x.com/y", [("org", "b")])],
        "u string, h array<struct<pattern:string,module:string>>",
    )
    assert [r[0] for r in df.select(RS.match_handler_col("u", "h")).collect()] == ["a", "b", None]


def test_archives_are_all_or_nothing(spark):
    whole = _zip([("a.md", "# a"), ("metadata/page_1.json", "{}"), ("scan.png", b"\xff\xfe")])
    broken = bytearray(_zip([("a.md", "# a"), ("metadata/page_1.json", "{}" * 50)]))
    at = broken.rfind(b"{}{}")
    broken[at : at + 4] = b"XXXX"
    latin = _zip([("a.md", "café".encode("latin-1")), ("b.md", "ok")])
    got = FS.unpack_archives(spark.createDataFrame([("w", whole), ("b", bytes(broken)), ("l", latin)], "path string, content binary")).collect()
    assert sorted((r.archive_path, r.entry_name, r.error is None) for r in got if r.archive_path == "w") == [("w", "a.md", True), ("w", "metadata/page_1.json", True)]
    assert [(r.archive_path, r.entry_name) for r in got if r.archive_path != "w"] == [("b", None), ("l", None)]


def test_sizes_as_the_json_has_them(spark):
    def best(a, b):
        return tuple(RS.best_file(_listing(spark, {"i": [{"name": "a.pdf", **a}, {"name": "b.pdf", **b}]})).select("best_name", "size_error").first())

    assert best({"size": 12.5}, {"size": 12}) == ("a.pdf", False)  # 12.5 is cut to 12, the first stays
    assert best({"size": " 1_000 "}, {"size": 999}) == ("a.pdf", False)
    assert best({"size": "1__2"}, {"size": 5}) == (None, True)
    assert best({"size": "12.5"}, {"size": 5}) == (None, True)
    assert best({"size": None}, {"size": 5}) == (None, True)
    assert best({}, {"size": "-1"}) == ("a.pdf", False)


def test_metadata_errors_fall_back(spark):
    items = spark.createDataFrame([("cut", '{"files": [{"name": "a.pdf", '), ("lost", None), ("none", "{}"), ("good", '{"files": [{"name": "g.pdf"}]}')], "item_id string, metadata string")
    cat = spark.createDataFrame([(f"https://h.test/details/{i}",) for i in ("cut", "lost", "none", "good", "unknown")], "url string")
    reg = RS.HandlerRegistry(default=RS.metadata_resolver(items, "https://h.test/download"))
    got = {r.url.rsplit("/", 1)[-1]: r.resolved_url for r in reg.dispatch(cat, "url", [("h.test", "any")]).collect()}
    assert got == {"cut": "https://h.test/download/cut/cut.pdf", "lost": "https://h.test/download/lost/lost.pdf", "none": "https://h.test/details/none",
                   "good": "https://h.test/download/good/g.pdf", "unknown": "https://h.test/details/unknown"}


def test_metadata_is_parsed_once(spark):
    """One pass over the items gives listing and errors; what it says is what the two passes say."""
    from corpusflow.sources.files import file_listing, file_listing_with_errors, metadata_errors

    texts = ['{"files": [{"name": "a.pdf", ', None, "{}", '{"files": null}', '{"files": [{"name": null}]}', '{"files": [{"size": 3}, {"name": "g.pdf", "size": "4"}]}', '{"files": []}', "[1]", '{"files": [null]}']
    items = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "item_id string, metadata string")
    got = file_listing_with_errors(items, "metadata", ["item_id"]).collect()
    bad = {r.item_id: r.reason for r in got if r.reason}
    assert bad == {r.item_id: r.reason for r in metadata_errors(items, "metadata", ["item_id"]).collect()} and len(bad) == 5
    assert all(r.pos is None for r in got if r.reason)
    want = [tuple(r) for r in file_listing(items, "metadata", ["item_id"]).collect() if r.item_id not in bad]
    assert sorted(tuple(r)[:-1] for r in got if not r.reason) == sorted(want)
    cat = spark.createDataFrame([("https://h.test/details/5",)], "url string")
    out = RS.metadata_resolver(items, "https://h.test/download")(cat, "url")
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(") == 1 and plan.count("Join") == 1
    assert out.first().resolved_url == "https://h.test/download/5/g.pdf"


def test_page_numbers_and_malformed_pages(spark):
    rows = [("a", "page_3.json", '{"page_num": "12", "blocks": [{"block_id": "x", "confidence": 0.5}]}'), ("b", "page_3.json", '{"page_num": 7, "blocks": [{"block_id": "y", "confidence": 0.5}]}'),
            ("c", "page_3.json", '{"blocks": [{"block_id": "z", "confidence": 0.5}]}'), ("d", "page_4.json", '{"blocks": [{'), ("e", "page_5.json", None)]
    pages = spark.createDataFrame(rows, "d string, f string, j string")
    assert sorted((r.d, r.page_num) for r in FS.block_rows(pages, "j", "f", ["d"]).collect()) == [("a", 12), ("b", 7), ("c", 3)]
    assert sorted((r.d, r.reason) for r in FS.block_rejects(pages, "j", "f", ["d"]).collect()) == [("d", "page metadata is malformed"), ("e", "page metadata is missing")]
