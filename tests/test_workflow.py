"""End-to-end: config -> state -> resume plan -> stage transition -> reset, twice."""

import json

from pyspark.sql import functions as F

from corpusflow.operators.resolve import HandlerRegistry
from corpusflow.plans import workflow as P
from corpusflow.sources import state as SS

CONFIG = {
    "domain_handlers": {"shelf.test": "shelf_handler"},
    "pages": [
        {"name": "Catalogue", "url": "https://books.example.org/php/plain_books.php", "language": "en-IN", "process_flag": True, "limit": None},
        {"name": "Loose Leaves", "url": None, "language": "en-IN", "process_flag": True, "limit": 2,
         "books": [
             {"id": "Q001", "title_original": "Winter Tales", "author_original": "Ann Lee", "pdf_url": "https://shelf.test/details/WT"},
             {"id": "Q009", "title_original": "River Songs", "author_original": "Bo Chen", "pdf_url": "https://shelf.test/download/B/b.pdf"},
             {"id": "Q011", "title_original": "Old Maps", "author_original": "Cy Diaz", "pdf_url": "https://other.org/x.pdf"},
             {"id": "Q009", "title_original": "River Songs", "author_original": "Bo Chen", "pdf_url": "https://other.org/b2.pdf"},
         ]},
        {"name": "Disabled", "url": None, "process_flag": False, "books": [{"id": "Z1", "title_original": "No", "pdf_url": "u"}]},
    ],
}

LIST_HTML = """<div class="books_from_db"><ul>
<li id="li_id1"><span class="titlespan"><a href="toc.php?book_id=101">First Book</a></span>
<span class="authorspan"><a href="#">Some Author</a></span><span class="downloadpdf"><a href="/pdfs/101/index.pdf">pdf</a></span></li>
<li id="li_id2"><span class="titlespan">No Link</span></li>
</ul></div>"""


def test_full_run_and_reset(spark, tmp_path):
    cfg = tmp_path / "config.json"
    cfg.write_text(json.dumps(CONFIG, ensure_ascii=False), encoding="utf-8")
    root = str(tmp_path / "state")
    lists = spark.createDataFrame([("https://books.example.org/php/plain_books.php", LIST_HTML)], "page_url string, html string")
    reg = HandlerRegistry().register(
        "shelf_handler",
        lambda d, c: d.withColumn("resolved_url", F.when(F.col(c).contains("/details/"), F.regexp_replace(F.col(c), "/details/", "/download/"))),
    )
    r1 = P.run_once(spark, str(cfg), root, list_pages=lists, registry=reg)
    assert r1["version"] == 1
    assert r1["planned"] == 3  # Assorted limited to 2 + 1 scraped
    s1 = {(r.page_slug, r.id): r for r in SS.load_state(spark, root).collect()}
    assert set(s1) == {("loose-leaves", "Q001"), ("loose-leaves", "Q009"), ("loose-leaves", "Q011"), ("plain_books", "101")}
    assert s1[("loose-leaves", "Q001")].pdf_url == "https://shelf.test/download/WT"
    assert s1[("loose-leaves", "Q009")].pdf_url == "https://other.org/b2.pdf"  # later duplicate wins
    assert s1[("loose-leaves", "Q001")].local_pdf_path == "raw_pdf/loose-leaves/Q001/Q001_winter-tales_ann-lee.pdf"
    assert s1[("plain_books", "101")].pdf_url == "https://books.example.org/pdfs/101/index.pdf"
    assert s1[("plain_books", "101")].local_pdf_path == "raw_pdf/plain_books/101/101_first-book_some-author.pdf"
    assert all(r.status == "pending" for r in s1.values())

    outcomes = spark.createDataFrame(
        [("loose-leaves", "Q001", True, True, True, True, True), ("loose-leaves", "Q009", False, False, False, False, False),
         ("loose-leaves", "Q011", True, True, True, True, True), ("plain_books", "101", True, False, True, True, True)],
        "page_slug string, id string, download_ok boolean, ocr_ok boolean, convert_ok boolean, md_copied boolean, docx_copied boolean",
    )
    r2 = P.run_once(spark, str(cfg), root, outcomes=outcomes, list_pages=lists, registry=reg)
    s2 = {r.id: r for r in SS.load_state(spark, root).collect()}
    assert r2["version"] == 2
    assert s2["Q001"].status == "completed" and s2["Q009"].status == "failed"
    assert s2["Q011"].status == "pending"  # beyond the page limit of 2: not processed
    assert s2["101"].status == "failed" and s2["101"].download_status == "completed"

    r3 = P.reset(spark, root)
    s3 = {r.id: r for r in SS.load_state(spark, root).collect()}
    assert r3["reset"] == 2
    assert s3["Q009"].status == "pending" and s3["101"].download_status == "pending" and s3["Q001"].status == "completed"


def test_cli_run_plan_reset(spark, tmp_path, capsys):
    from corpusflow.__main__ import main

    cfg = tmp_path / "config.json"
    cfg.write_text(json.dumps(CONFIG, ensure_ascii=False), encoding="utf-8")
    root = str(tmp_path / "state")
    assert main(["run", "--config", str(cfg), "--state", root]) == 0
    assert json.loads(capsys.readouterr().out.strip().splitlines()[-1])["version"] == 1
    out = str(tmp_path / "plan")
    assert main(["plan", "--config", str(cfg), "--state", root, "--out", out]) == 0
    plan = spark.read.parquet(out)
    assert plan.count() == 2 and set(plan.columns) >= {"page_slug", "id", "ordinal", "total", "remaining"}
    assert main(["reset", "--state", root, "--page-slug", "loose-leaves"]) == 0
    assert json.loads(capsys.readouterr().out.strip().splitlines()[-1])["version"] == 2


KN_HTML = """<div class="books_from_db"><ul>
<li id="li_id1"><span class="titlespan"><a href="toc.php?book_id=201">ಕನ್ನಡ ಪುಸ್ತಕ</a></span>
<span class="authorspan"><a href="#">ಲೇಖಕ</a></span><span class="downloadpdf"><a href="/pdfs/201/index.pdf">pdf</a></span></li>
<li id="li_id2"><span class="titlespan"><a href="toc.php?book_id=202">Second</a></span>
<span class="authorspan"><a href="#">Other</a></span><span class="downloadpdf"><a href="/pdfs/202/index.pdf">pdf</a></span></li>
</ul></div>"""


def test_enrichment_by_language_prefix_with_state_cache(spark, tmp_path):
    """The provider runs for pages whose language prefix is listed; slugs already in
    state (both non-empty) are reused; D5: inline books keep their own language."""
    cfg = {
        "pages": [
            {"name": "Kannada", "url": "https://books.example.org/php/hill_library.php", "language": "kn-IN", "process_flag": True},
            {"name": "Inline", "url": None, "language": "en-IN", "process_flag": True,
             "books": [{"id": "A8", "title_original": "T", "author_original": "A", "pdf_url": "u", "language": "kn-IN"}]},
        ]
    }
    path = tmp_path / "c.json"
    path.write_text(json.dumps(cfg, ensure_ascii=False), encoding="utf-8")
    root = str(tmp_path / "state")
    lists = spark.createDataFrame([("https://books.example.org/php/hill_library.php", KN_HTML)], "page_url string, html string")

    def romanize(texts):
        return texts.map(lambda t: {"ಕನ್ನಡ ಪುಸ್ತಕ": "Kannada Pustaka", "ಲೇಖಕ": "Lekhaka"}.get(t, "X " + t))

    P.run_once(spark, str(path), root, list_pages=lists, enrich_languages={"kn"}, provider=romanize)
    s1 = {r.id: r for r in SS.load_state(spark, root).collect()}
    assert (s1["201"].title_english_slug, s1["201"].author_english_slug) == ("kannada-pustaka", "lekhaka")
    assert s1["201"].local_pdf_path == "raw_pdf/hill_library/201/201_kannada-pustaka_lekhaka.pdf"
    assert (s1["202"].title_english_slug, s1["202"].author_english_slug) == ("x-second", "x-other")
    assert s1["A8"].language == "kn-IN"

    def failing(texts):
        raise RuntimeError("must not be called for cached rows")

    P.run_once(spark, str(path), root, list_pages=lists, enrich_languages={"kn"}, provider=failing)
    s2 = {r.id: r for r in SS.load_state(spark, root).collect()}
    assert (s2["201"].title_english_slug, s2["202"].author_english_slug) == ("kannada-pustaka", "x-other")


def test_ocr_results_end_to_end(spark, tmp_path):
    import io
    import zipfile

    def zipped(entries):
        buf = io.BytesIO()
        with zipfile.ZipFile(buf, "w") as z:
            for n, d in entries:
                z.writestr(n, d)
        return buf.getvalue()

    page = lambda n, confs: json.dumps({"page_num": n, "blocks": [{"block_id": f"b{i}", "confidence": c} for i, c in enumerate(confs)]})
    d = tmp_path / "out"
    d.mkdir()
    (d / "d1__1.zip").write_bytes(zipped([("d1_part_1.md", "one"), ("metadata/page_1.json", page(1, [0.9, 0.5]))]))
    (d / "d1__2.zip").write_bytes(zipped([("d1_part_2.md", "two"), ("metadata/page_1.json", page(1, [0.8]))]))
    (d / "d2__1.zip").write_bytes(zipped([("d2_part_1.md", "x"), ("metadata/page_3.json", page(3, [0.1]))]))
    (d / "d2__2.zip").write_bytes(zipped([("d2_part_2.md", "y")]))  # no metadata: nothing to average
    (d / "d5__0.zip").write_bytes(zipped([("d5.md", "z"), ("metadata/page_1.json", page(1, [0.4])), ("metadata/page_2.json", '{"page_num": 2, "blo')]))
    (d / "d6__0.zip").write_bytes(zipped([("d6.md", "only text")]))
    (d / "again").mkdir()
    (d / "again" / "d6__0.zip").write_bytes(zipped([("d6.md", "first by path")]))
    (d / "d7__0.zip").write_bytes(zipped([("notes.txt", ""), ("metadata/page_1.json", page(1, []))]))
    (d / "d3__0.zip").write_bytes(zipped([("d3.md", "whole"), ("metadata/page_2.json", page(2, [0.6]))]))
    plan = spark.createDataFrame([("d1", 1), ("d1", 2), ("d2", 1), ("d2", 2), ("d3", None), ("d4", None), ("d5", None), ("d6", None), ("d6", None), ("d7", None)], "doc string, part int")
    documents, rejects = P.ocr_tables(spark, str(d), plan)
    got = {r.doc: r for r in documents.collect()}
    lost = sorted((r.archive_path.rsplit(f"{d}/", 1)[1], r.file_name, r.reason) for r in rejects.collect())
    assert lost == [("d5__0.zip", "page_2.json", "page metadata is malformed"), ("d6__0.zip", None, "another archive of this chunk was taken"), ("d7__0.zip", None, "archive has no markdown")]
    sep = "\n\n---\n\n"
    assert got["d1"].ocr_ok and got["d1"].merged_text == "one" + sep + "two" + sep
    assert got["d1"].low_confidence_blocks_count == 1 and abs(got["d1"].avg_page_confidence - (0.9 + 0.5 + 0.8) / 3) < 1e-12
    assert got["d1"].pages_with_low_confidence_blocks == [1]  # both parts' page_1 counted (keyed by part)
    assert got["d2"].ocr_ok and got["d2"].merged_text == "x" + sep + "y" + sep and got["d2"].avg_page_confidence == 0.1
    assert not got["d5"].ocr_ok and got["d5"].merged_text is None and not got["d7"].ocr_ok
    assert got["d6"].ocr_ok and got["d6"].n_chunks == 1 and got["d6"].merged_text == "first by path" and got["d6"].avg_page_confidence is None
    assert got["d3"].ocr_ok and got["d3"].merged_text == "whole" and got["d3"].pages_with_low_confidence_blocks == [2]
    assert not got["d4"].ocr_ok


def test_cache_from_run_to_run_modules_and_rejects(spark, tmp_path):
    """Answers of one run serve the next, whatever its state; the config's modules resolve URLs; what can't be
    kept is written with its reason."""
    cfg = {
        "domain_handlers": {"plain.test": "corpusflow.plans.handlers.secure", "gone.test": "no.such.module"},
        "pages": [
            {"name": "Kannada", "url": "https://books.example.org/php/hill_library.php", "language": "kn-IN", "process_flag": True},
            {"name": "Unfetched", "url": "https://books.example.org/php/nowhere.php", "process_flag": True},
            {"name": "Inline", "url": None, "language": "en-IN", "process_flag": True,
             "books": [{"id": "A8", "title_original": "T", "pdf_url": "http://plain.test/ab"}, {"title_original": "No id", "pdf_url": "u"},
                       {"id": "B", "title_original": "G", "pdf_url": "http://gone.test/b"}, {"id": "A8", "title_original": "T2", "pdf_url": "http://plain.test/abc"}]},
        ],
    }
    path = tmp_path / "config.json"
    path.write_text(json.dumps(cfg), encoding="utf-8")
    lists = spark.createDataFrame([("https://books.example.org/php/hill_library.php", KN_HTML.replace("</ul>", '<li id="li_id3"><span class="titlespan">No Link</span></li></ul>'))], "page_url string, html string")

    def run(root, provider):
        return P.run_once(spark, str(path), f"{tmp_path}/{root}", list_pages=lists, enrich_languages={"kn"}, provider=provider, modules=True, cache_dir=f"{tmp_path}/cache")

    def failing(texts):
        raise RuntimeError("every answer is in the cache")

    def spell(texts):
        return texts.map(lambda t: f"spelt {len(t)}")

    r = run("one", spell)
    assert r["rejected"] == 4 and r["planned"] == 4
    rejects = {(x["page_slug"], x["id"], x["reason"]) for x in P.run_table(spark, f"{tmp_path}/one", "rejects").collect()}
    assert rejects == {("hill_library", None, "no pdf url, id"), ("nowhere", None, "list page wasn't fetched"), ("inline", None, "book has no id"), ("inline", "A8", "listed again later")}
    assert P.run_table(spark, f"{tmp_path}/one", "plan").count() == 4
    run("two", failing)
    one, two = ({x.id: (x.title_english_slug, x.pdf_url) for x in SS.load_state(spark, f"{tmp_path}/{n}").collect()} for n in ("one", "two"))
    assert one == two and one["202"][0] == "spelt-6"
    assert one["A8"][1] == "https://plain.test/abc#secure" and one["B"][1] == "http://gone.test/b"
    # again over its own state: matched, not inserted
    assert run("two", failing)["version"] == 2 and SS.load_state(spark, f"{tmp_path}/two").count() == len(two)
