"""Catalogue rows from list pages.

Two modes, same output columns:

* ``regex_items`` — flat items (no nesting inside an item), JVM-side
  ``regexp_extract_all`` + ``posexplode``; the fast path.
* ``dom_items`` — real nested markup, parsed per page with the stdlib
  ``html.parser`` inside ``mapInPandas`` (Arrow batches, one page per row).
"""

from __future__ import annotations

import re
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusflow.functions.html import unescape
from corpusflow.functions.text import WS

# --- fixed values: catalogue markup and id patterns --------------------------
CONTAINER_CLASS = "books_from_db"
ITEM_ID_PATTERN = r"li_id\d+"
TITLE_CLASS = "titlespan"
AUTHOR_CLASS = "authorspan"
DOWNLOAD_CLASS = "downloadpdf"
AUTHOR_DASH = "—"
ID_PATTERNS = [r"book_id=(\d+[A-Z]?)", r"/(\d{3,}[A-Z]?)/index\.pdf"]
# ---------------------------------------------------------------------------

ITEM_COLUMNS = ["item_pos", "title_original", "author_original", "title_href", "pdf_href"]


def _strip(c: Column) -> Column:
    return F.regexp_replace(c, f"^[{WS}]+|[{WS}]+$", "")


def regex_items(pages: DataFrame, html_col: str, pattern: str, groups: dict[str, int]) -> DataFrame:
    """One row per regex match of ``pattern`` in ``html_col`` with the named groups,
    ``item_pos`` = 0-based match position. Group text is entity-decoded and stripped."""
    keep = [c for c in pages.columns if c != html_col]
    arrays = [F.regexp_extract_all(F.col(html_col), F.lit(pattern), g).alias(n) for n, g in groups.items()]
    zipped = F.arrays_zip(*arrays)
    ex = pages.select(*keep, F.posexplode(zipped).alias("item_pos", "_m"))
    return ex.select(*keep, "item_pos", *[_strip(unescape(F.col("_m")[n])).alias(n) for n in groups])


def catalogue_id(title_href, pdf_href, patterns: list[str] | None = None) -> Column:
    """Id from the title link (first pattern), else from the pdf link (the others)."""
    pats = patterns or ID_PATTERNS
    t = F.col(title_href) if isinstance(title_href, str) else title_href
    p = F.col(pdf_href) if isinstance(pdf_href, str) else pdf_href
    cands = [F.nullif(F.regexp_extract(t, pats[0], 1), F.lit(""))]
    cands += [F.nullif(F.regexp_extract(p, q, 1), F.lit("")) for q in pats[1:]]
    return F.coalesce(*cands, F.lit(""))


def complete_items(items: DataFrame) -> Column:
    """F4 predicate: title, pdf href and id are all non-empty."""
    ok = lambda c: F.coalesce(F.col(c), F.lit("")) != F.lit("")
    return ok("title_original") & ok("pdf_href") & ok("id")


def reject_reason() -> Column:
    """which of title, pdf href and id an incomplete item lacks (null: complete)."""
    lacks = [F.when(F.coalesce(F.col(c), F.lit("")) == F.lit(""), F.lit(n)) for c, n in (("title_original", "title"), ("pdf_href", "pdf url"), ("id", "id"))]
    missing = F.concat_ws(", ", *lacks)
    return F.when(missing != "", F.concat(F.lit("no "), missing))


# --- DOM mode ----------------------------------------------------------------


# elements that never have content
VOID_TAGS = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}


class _Node:
    __slots__ = ("tag", "attrs", "parent", "children")

    def __init__(self, tag: str, attrs: dict[str, str], parent: _Node | None):
        self.tag, self.attrs, self.parent, self.children = tag, attrs, parent, []

    def walk(self):
        """Descendants (elements and text) in document order, without recursion."""
        todo = self.children[::-1]
        while todo:
            x = todo.pop()
            yield x
            if isinstance(x, _Node):
                todo += x.children[::-1]

    def find(self, tag: str, cls: str | None = None) -> _Node | None:
        return next((x for x in self.walk() if isinstance(x, _Node) and x.is_(tag, cls)), None)

    def is_(self, tag: str, cls: str | None) -> bool:
        return self.tag == tag and (cls is None or cls in self.attrs.get("class", "").split())

    def text(self) -> str:
        """Every piece of text stripped, then joined."""
        return "".join(x.strip() for x in self.walk() if isinstance(x, str))

    def next_sibling(self, tag: str, cls: str) -> _Node | None:
        own = self.parent.children
        after = own[next(i for i, x in enumerate(own) if x is self) + 1 :]
        return next((x for x in after if isinstance(x, _Node) and x.is_(tag, cls)), None)


class _TreeParser(HTMLParser):
    """A lenient tree: an end tag closes the nearest open element of its name and all within it;
    one that matches no open element is ignored; what stays open ends with its parent."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.at = _Node("", {}, None)

    def handle_starttag(self, tag, attrs):
        node = _Node(tag, {k: v or "" for k, v in attrs}, self.at)
        self.at.children.append(node)
        if tag not in VOID_TAGS:
            self.at = node

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        self.handle_endtag(tag)

    def handle_endtag(self, tag):
        node = self.at
        while node is not None and node.tag != tag:
            node = node.parent
        if node is not None and node.parent is not None:
            self.at = node.parent

    def handle_data(self, data):
        if self.at.tag not in ("script", "style"):
            self.at.children.append(data)


def _fields(item: _Node) -> dict:
    out = {"title_original": "", "author_original": "", "title_href": "", "pdf_href": ""}
    title = item.find("span", TITLE_CLASS)
    if title is not None:
        link = title.find("a")
        out["title_original"] = (link or title).text()
        out["title_href"] = link.attrs.get("href", "") if link else ""
    author = item.find("span", AUTHOR_CLASS)
    if author is not None:
        link = author.find("a")
        if link is not None:
            out["author_original"] = link.text()
        else:
            out["author_original"] = author.text().replace(AUTHOR_DASH, "").strip()
            other = author.next_sibling("span", AUTHOR_CLASS)
            if not out["author_original"] and other is not None:
                out["author_original"] = other.text()
    download = item.find("span", DOWNLOAD_CLASS)
    link = download.find("a") if download is not None else None
    if link is not None:
        out["pdf_href"] = link.attrs.get("href", "")
    return out


def parse_catalogue_html(html: str | None) -> list[dict]:
    """The items of the first ``div.books_from_db``, at any depth."""
    if not html:
        return []
    p = _TreeParser()
    p.feed(html)
    p.close()
    container = p.root.find("div", CONTAINER_CLASS)
    if container is None:
        return []
    items = [x for x in container.walk() if isinstance(x, _Node) and x.tag == "li" and re.search(ITEM_ID_PATTERN, x.attrs.get("id", ""))]
    return [dict(item_pos=k, **_fields(x)) for k, x in enumerate(items)]


def dom_items(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """Catalogue items from nested markup: one output row per list item."""
    keep = [c for c in pages.columns if c != html_col]
    schema_keep = pages.select(*keep).schema
    out_schema = ", ".join(
        [f"`{f.name}` {f.dataType.simpleString()}" for f in schema_keep.fields]
        + ["item_pos int", "title_original string", "author_original string", "title_href string", "pdf_href string"]
    )

    def run(batches):
        for pdf in batches:
            rows = []
            for rec in pdf.to_dict("records"):
                html = rec.pop(html_col)
                for it in parse_catalogue_html(html):
                    rows.append({**rec, **it})
            yield pd.DataFrame(rows, columns=keep + ITEM_COLUMNS)

    return pages.mapInPandas(run, out_schema)
