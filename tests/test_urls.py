"""URL functions against urllib.parse."""

import re
from urllib.parse import quote, urljoin, urlparse

from conftest import col_values
from corpusflow.functions import urls as U


def py_page_slug(url):
    from test_text import expected_slug

    path = urlparse(url).path
    for seg in path.split("/"):
        if ".php" in seg:
            return expected_slug(seg.split(".php")[0])
    return expected_slug(path.replace("/", "_").strip("_"))


def py_page_slug_admin(url):
    path = urlparse(url).path
    for seg in path.split("/"):
        if ".php" in seg:
            return seg.split(".php")[0].replace("/", "_").strip("_")
    return path.replace("/", "_").strip("_")


URLS = [
    "https://books.example.org/php/kannada_books.php",
    "https://example.org/php/english_books.php?x=1",
    "http://user:pw@host.example.com:8080/a/b;params?q#f",
    "https://archive.org/details/Some Item/page/n10/mode/1up?hl=en",
    "https://host/a.php.bak/b",
    "https://host/",
    "https://host",
    "http://blog.x.example.net/en/12#top",
]


def test_page_slug(spark):
    assert col_values(spark, URLS, U.page_slug("x")) == [py_page_slug(u) for u in URLS]
    assert col_values(spark, URLS, U.page_slug_admin("x")) == [py_page_slug_admin(u) for u in URLS]


def test_authority_and_path(spark):
    assert col_values(spark, URLS, U.url_authority("x")) == [urlparse(u).netloc for u in URLS]
    assert col_values(spark, URLS, U.url_path("x")) == [urlparse(u).path for u in URLS]


def test_null_url_uses_page_name(spark):
    df = spark.createDataFrame([(None, "Assorted Books")], "u string, n string")
    assert df.select(U.page_slug("u", "n")).collect()[0][0] == "assorted-books"


def test_item_identifier(spark):
    vals = URLS + ["https://archive.org/details/dli.ernet.1042", "https://archive.org/download/x/y.pdf"]
    exp = []
    for u in vals:
        m = re.search(r"/details/([^/]+)", urlparse(u).path)
        exp.append(m.group(1) if m else None)
    assert col_values(spark, vals, U.item_identifier("x")) == exp


def test_url_quote(spark):
    vals = ["Bhaskari III - K C Pandey.pdf", "a+b*c~d/e", "ಕನ್ನಡ (1930).pdf", "100% sure?&=#"]
    assert col_values(spark, vals, U.url_quote("x")) == [quote(v) for v in vals]


BASES = ["https://host.example.com/dir/page.php?x=1#frag", "https://host", "http://h/a/b/", "http://h/a/b/c", "https://u:p@h:8080/x/y;p?q=1"]
HREFS = ["/abs", "rel/x.pdf", "//other.org/p", "?q=2", "#top", "", "https://z.org/a", "../up/file", "./same", "/a/./b/../c",
         "mailto:x@y", "..", ".", "../../../../g", "g/", "g/.", "g/..", "/..", "//g/../x", "a//b/../c", "?y#s", "http:rel",
         "https:rel", "g;x?y#s", "/the,", "/für", "x/./y/../../z/"]


def test_url_join(spark):
    rows = [(i, b, h) for i, (b, h) in enumerate((b, h) for b in BASES for h in HREFS)]
    df = spark.createDataFrame(rows, "i int, b string, h string")
    got = [r[0] for r in df.orderBy("i").select(U.url_join("b", "h")).collect()]
    assert got == [urljoin(b, h) for _, b, h in rows]


def test_state_name(spark):
    assert col_values(spark, ["kannada_books"], U.state_name("x")) == ["processing_state_kannada_books.json"]
