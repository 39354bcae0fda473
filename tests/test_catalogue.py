"""Catalogue extraction: DOM mode follows the reference's field rules; regex mode on flat items."""


from corpusflow.sources import catalogue as SC

HTML = """
<html><body>
<ul><li id="li_id1"><span class="titlespan"><a href="toc.php?book_id=999">Outside</a></span></li></ul>
<div class="books_from_db">
  <ul>
    <li id="li_id10">
      <span class="titlespan"><a href="toc.php?book_id=123A"> Title &amp; <b>One</b> </a></span>
      <span class="authorspan"><a href="a.php">Author One</a></span>
      <span class="downloadpdf"><a href="/pdfs/0123/index.pdf">pdf</a></span>
    </li>
    <li id="x_li_id11">
      <span class="titlespan">Plain Title</span>
      <span class="authorspan"> — </span><span class="authorspan">Next Author</span>
      <span class="downloadpdf"><a href="/pdfs/4567B/index.pdf">pdf</a></span>
    </li>
    <li id="other"><span class="titlespan">Skipped</span></li>
    <li id="li_id12">
      <span class="titlespan"><a href="toc.php">No Id</a></span>
      <span class="authorspan">Dash — Name</span>
    </li>
  </ul>
</div>
<div class="books_from_db"><li id="li_id99"><span class="titlespan">Second container</span></li></div>
</body></html>
"""


def test_parse_catalogue_html_rules():
    items = SC.parse_catalogue_html(HTML)
    # get_text(strip=True): each text node stripped, then joined
    assert [i["title_original"] for i in items] == ["Title &One", "Plain Title", "No Id"]
    assert items[0]["author_original"] == "Author One"
    assert items[0]["title_href"] == "toc.php?book_id=123A"
    assert items[1]["author_original"] == "Next Author"
    assert items[1]["pdf_href"] == "/pdfs/4567B/index.pdf"
    assert items[2]["author_original"] == "Dash  Name"
    assert items[2]["pdf_href"] == ""


def test_dom_items_and_ids(spark):
    pages = spark.createDataFrame([(1, HTML), (2, "<html>no container</html>"), (3, None)], "page_id int, html string")
    items = SC.dom_items(pages, "html").withColumn("id", SC.catalogue_id("title_href", "pdf_href"))
    rows = items.orderBy("page_id", "item_pos").collect()
    assert [(r.page_id, r.id) for r in rows] == [(1, "123A"), (1, "4567B"), (1, "")]
    complete = items.filter(SC.complete_items(items)).count()
    assert complete == 2


def test_regex_items_positions_and_entities(spark):
    html = '<li><a href="/a">A &amp; B</a></li><li><a href="/b,">  b </a></li>'
    pages = spark.createDataFrame([(1, html)], "page_id int, html string")
    rows = SC.regex_items(pages, "html", r'<li><a href="([^"]*)">([^<]*)</a></li>', {"href": 1, "text": 2}).collect()
    assert [(r.item_pos, r.href, r.text) for r in rows] == [(0, "/a", "A & B"), (1, "/b,", "b")]


def test_real_markup():
    """Stray and unclosed tags, nested spans, entities beyond the flat list."""
    li = '<li id="li_id{0}"><span><span class="titlespan x"><a href="t?book_id={0}">T&eacute;{0}</a></span></span>{1}<span class="downloadpdf"><a href="/p{0}">pdf</a></span>'
    html = '<div class="a books_from_db"><ul>' + li.format(1, "") + "</li>" + li.format(2, "</b>") + "</li>" + li.format(3, "<br><img src=x>") + li.format(4, "") + "</ul></div></div><li id='li_id9'>no</li>"
    items = SC.parse_catalogue_html(html)
    assert [(i["title_original"], i["title_href"], i["pdf_href"]) for i in items] == [(f"Té{k}", f"t?book_id={k}", f"/p{k}") for k in (1, 2, 3, 4)]
    deep = SC.parse_catalogue_html('<div class="books_from_db">' + "".join(li.format(k, "") for k in range(3000)))
    assert len(deep) == 3000 and deep[-1]["pdf_href"] == "/p2999"
