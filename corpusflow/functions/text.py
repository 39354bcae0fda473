"""Text normalisation as JVM-side Column expressions (no Python on the hot path).

Every builder takes and returns a ``Column`` so Catalyst can fold, prune and
codegen them inside whole-stage spans.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: behaviour that must match the reference exactly ---------
# Python's ``\s`` (str.isspace) as an explicit class; Java's ``\s`` is ASCII only.
WS = r"\t\n\x0b\x0c\r\x1c-\x1f\x85\p{Z}"
# Python's ``\w`` = letters, numbers and underscore, *without* combining marks.
WORD = r"\p{L}\p{N}_"
# File-name slug cap and its marker: 47 characters + "...".
SLUG_MAX = 50
ELLIPSIS = "..."
# zfill width of ids in directory names.
ID_WIDTH = 3
# ---------------------------------------------------------------------------

_DROP = f"[^{WORD}{WS}-]"
_EDGE_WS = f"^[{WS}]+|[{WS}]+$"
_RUNS = f"[-{WS}]+"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def slugify(x) -> Column:
    """Drop chars outside word/space/hyphen, strip, lower, collapse ``[-\\s]+`` to ``-``.

    Leading/trailing hyphens are kept (pipeline variant)."""
    c = F.regexp_replace(_c(x), _DROP, "")
    c = F.lower(F.regexp_replace(c, _EDGE_WS, ""))
    return F.regexp_replace(c, _RUNS, "-")


def slugify_admin(x) -> Column:
    """Admin variant: lower first, drop, collapse, then strip ``-`` at both ends."""
    c = F.regexp_replace(F.lower(_c(x)), _DROP, "")
    c = F.regexp_replace(c, _RUNS, "-")
    return F.regexp_replace(c, "^-+|-+$", "")


def ascii_fold(x) -> Column:
    """Drop every non-ASCII code point, then slugify (the offline fallback)."""
    return slugify(F.regexp_replace(_c(x), r"[^\x00-\x7F]", ""))


def ellipsize(x, n: int = SLUG_MAX) -> Column:
    """Code-point length > n -> first n-3 characters + '...'."""
    c = _c(x)
    return F.when(F.length(c) > n, F.concat(F.substring(c, 1, n - len(ELLIPSIS)), F.lit(ELLIPSIS))).otherwise(c)


def zfill_id(x, width: int = ID_WIDTH) -> Column:
    """Python ``str.zfill``: pad with zeros after an optional sign, never truncate."""
    c = _c(x)
    return (
        F.when(F.length(c) >= width, c)
        .when(c.rlike("^[+-]"), F.concat(F.substring(c, 1, 1), F.lpad(F.substring(c, 2, 2147483647), width - 1, "0")))
        .otherwise(F.lpad(c, width, "0"))
    )


def strip_chars(x, chars: str) -> Column:
    """``str.strip(chars)`` for a set of literal characters."""
    import re

    cls = "[" + "".join(re.escape(ch) for ch in chars) + "]"
    return F.regexp_replace(_c(x), f"^{cls}+|{cls}+$", "")


def swap_suffix(x, new_suffix: str, old_suffix: str = ".pdf") -> Column:
    """``name.replace('.pdf', new)`` — replaces *every* occurrence."""
    return F.replace(_c(x), F.lit(old_suffix), F.lit(new_suffix))


def basename(x) -> Column:
    """Last path segment ('' when the path ends with '/')."""
    return F.regexp_extract(_c(x), r"([^/]+)$", 1)


def stem(x) -> Column:
    """``os.path.splitext(name)[0]``: drop the last extension unless the name is only dots before it."""
    return F.regexp_replace(_c(x), r"^(.*?[^.].*)\.[^.]*$", "$1")


def combined_slug(title_slug, author_slug, n: int = SLUG_MAX) -> Column:
    """Inline-book name part: ``ellipsize(strip_('{t}_{a}'), n)``."""
    joined = F.concat(_c(title_slug), F.lit("_"), _c(author_slug))
    return ellipsize(strip_chars(joined, "_"), n)


def scraped_slug(title_slug, author_slug, n: int = SLUG_MAX) -> Column:
    """Scraped-book name part: each slug ellipsized separately, empty parts dropped, joined by '_'."""
    t = ellipsize(_c(title_slug), n)
    a = ellipsize(_c(author_slug), n)
    return F.concat_ws("_", F.nullif(t, F.lit("")), F.nullif(a, F.lit("")))
