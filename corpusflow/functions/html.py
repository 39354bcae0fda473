"""HTML helpers for flat markup, as Column expressions.

Regex extraction is exact only for flat items (no nesting inside the matched
element); nested catalogue markup goes through ``sources.catalogue.dom_items``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusflow.functions.text import WS

# --- fixed values: named entities decoded natively (``&amp;`` must be last) ----
ENTITIES = [
    ("&lt;", "<"),
    ("&gt;", ">"),
    ("&quot;", '"'),
    ("&#39;", "'"),
    ("&apos;", "'"),
    ("&nbsp;", "\u00a0"),
    ("&copy;", "©"),
    ("&middot;", "·"),
    ("&amp;", "&"),
]
# ---------------------------------------------------------------------------


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def unescape(x) -> Column:
    """Single-pass decode of the fixed entity list (``&amp;lt;`` -> ``&lt;``)."""
    c = _c(x)
    for ent, ch in ENTITIES:
        c = F.replace(c, F.lit(ent), F.lit(ch))
    return c


def tag_text(html, tag: str) -> Column:
    """Text of the first ``<tag ...>text</tag>`` (flat content), entity-decoded and stripped."""
    raw = F.regexp_extract(_c(html), f"(?s)<{tag}(?:\\s[^>]*)?>([^<]*)</{tag}>", 1)
    return F.regexp_replace(unescape(raw), f"^[{WS}]+|[{WS}]+$", "")


def html_lang(html) -> Column:
    return F.regexp_extract(_c(html), r"<html[^>]*\slang=\"([^\"]*)\"", 1)
