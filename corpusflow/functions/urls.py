"""URL handling as Column expressions, following Python ``urllib.parse`` semantics.

``parse_url`` raises on URLs with blanks and ``try_parse_url`` returns null for
them, while Python still splits them; so the split is done with one regex that
mirrors ``urlsplit`` (scheme, ``//netloc``, path up to ``?``/``#``).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusflow.functions.text import slugify, strip_chars

# --- fixed values -----------------------------------------------------------
# urlsplit: optional scheme, optional //netloc, then path up to '?' or '#'.
URL_SPLIT = r"^(?:([A-Za-z][A-Za-z0-9+.-]*):)?(?://([^/?#]*))?([^?#]*)"
STATE_PREFIX = "processing_state_"
STATE_SUFFIX = ".json"
PHP_MARK = ".php"
# ---------------------------------------------------------------------------


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def url_authority(x) -> Column:
    """``urlparse(u).netloc`` (userinfo and port included)."""
    return F.regexp_extract(_c(x), URL_SPLIT, 2)


def url_path(x) -> Column:
    """``urlparse(u).path``: ``;params`` of the last segment are split off."""
    return F.regexp_replace(F.regexp_extract(_c(x), URL_SPLIT, 3), r";[^/]*$", "")


def _first_php_segment(path: Column) -> Column:
    segs = F.filter(F.split(path, "/"), lambda s: s.contains(PHP_MARK))
    return F.get(segs, 0)


def page_slug(url, name=None) -> Column:
    """Pipeline page slug: first ``.php`` segment (text before '.php') slugified,
    else the slugified path with '/' -> '_' and '_' trimmed; null or empty url -> slug of the page name."""
    path = url_path(url)
    php = _first_php_segment(path)
    from_url = F.when(php.isNotNull(), slugify(F.substring_index(php, PHP_MARK, 1))).otherwise(
        slugify(strip_chars(F.replace(path, F.lit("/"), F.lit("_")), "_"))
    )
    if name is None:
        return from_url
    return F.when(F.coalesce(_c(url), F.lit("")) == "", slugify(_c(name))).otherwise(from_url)


def page_slug_admin(url, name=None) -> Column:
    """Admin-tool page slug: same rule without slugify (case and punctuation kept)."""
    path = url_path(url)
    php = _first_php_segment(path)
    from_url = F.when(
        php.isNotNull(), strip_chars(F.replace(F.substring_index(php, PHP_MARK, 1), F.lit("/"), F.lit("_")), "_")
    ).otherwise(strip_chars(F.replace(path, F.lit("/"), F.lit("_")), "_"))
    if name is None:
        return from_url
    from corpusflow.functions.text import slugify_admin

    return F.when(F.coalesce(_c(url), F.lit("")) == "", slugify_admin(_c(name))).otherwise(from_url)


def item_identifier(url, segment: str = "details") -> Column:
    """``/{segment}/([^/]+)`` searched in the path only; null when absent."""
    return F.nullif(F.regexp_extract(url_path(url), f"/{segment}/([^/]+)", 1), F.lit(""))


def url_quote(x) -> Column:
    """``urllib.parse.quote(x)`` (safe='/'): url_encode, then fix the four differences."""
    c = F.url_encode(_c(x))
    for a, b in (("+", "%20"), ("*", "%2A"), ("%7E", "~"), ("%2F", "/")):
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def state_name(slug) -> Column:
    return F.concat(F.lit(STATE_PREFIX), _c(slug), F.lit(STATE_SUFFIX))


def _resolve_segments(segs: Column) -> Column:
    """urljoin's segment walk: '..' pops (ignored when empty), '.' is skipped; a trailing
    '.' or '..' leaves a trailing '/'. Empty result -> '/'."""
    walked = F.aggregate(
        segs,
        F.array().cast("array<string>"),
        lambda acc, s: F.when(s == "..", F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))))
        .when(s == ".", acc)
        .otherwise(F.array_append(acc, s)),
    )
    walked = F.when(F.element_at(segs, -1).isin(".", ".."), F.array_append(walked, F.lit(""))).otherwise(walked)
    joined = F.array_join(walked, "/")
    # urlunparse puts a '/' in front of a path that lost its root
    return F.when(joined.startswith("/"), joined).otherwise(F.concat(F.lit("/"), joined))


def url_join(base, href) -> Column:
    """``urljoin(base, href)`` for hierarchical (http-like) bases, fully JVM-side:
    empty href -> base; another scheme -> href; ``//host`` -> base scheme + href;
    otherwise the path is merged with the base directory (absolute paths replace it) and
    dot segments are resolved with urljoin's stack walk. ``;params`` stay in the path."""
    b, h0 = _c(base), _c(href)
    bscheme = F.regexp_extract(b, URL_SPLIT, 1)
    hscheme = F.regexp_extract(h0, r"^([A-Za-z][A-Za-z0-9+.-]*):", 1)
    same_scheme = (hscheme != "") & (F.lower(hscheme) == F.lower(bscheme))
    after = F.regexp_replace(h0, r"^[^:]*:", "")
    # 'http:rel' against an http base is the relative reference 'rel'
    h = F.when(same_scheme & ~after.startswith("//"), after).otherwise(h0)
    auth = url_authority(b)
    bpath = F.regexp_extract(b, URL_SPLIT, 3)
    bquery = F.regexp_extract(b, r"^[^?#]*(\?[^#]*)", 1)
    origin = F.concat(bscheme, F.lit("://"), auth)
    hpath = F.regexp_extract(h, r"^([^?#]*)", 1)
    htail = F.regexp_extract(h, r"^[^?#]*(.*)$", 1)
    hquery = F.regexp_extract(h, r"^[^?#]*(\?[^#]*)", 1)
    # merge: base directory segments + href segments, empty middle segments dropped
    bparts = F.split(bpath, "/")
    bdir = F.when(F.element_at(bparts, -1) != "", F.slice(bparts, 1, F.size(bparts) - 1)).otherwise(bparts)
    merged = F.concat(bdir, F.split(hpath, "/"))
    n = F.size(merged)
    middle = F.filter(F.slice(merged, 2, F.greatest(n - 2, F.lit(0))), lambda x: x != "")
    merged = F.when(n <= 2, merged).otherwise(F.concat(F.slice(merged, 1, 1), middle, F.slice(merged, -1, 1)))
    segs = F.when(hpath.startswith("/"), F.split(hpath, "/")).otherwise(merged)
    resolved = F.concat(origin, _resolve_segments(segs), htail)
    # no path: base path, and the base query unless the href has one
    no_path = F.concat(origin, bpath, F.when(hquery != "", F.lit("")).otherwise(bquery), htail)
    other_scheme = (hscheme != "") & ~same_scheme
    return (
        F.when(b.isNull() | h0.isNull(), F.lit(None).cast("string"))
        .when(h0 == "", b)
        .when(b == "", h0)
        .when(other_scheme | (same_scheme & after.startswith("//")), h0)
        .when(h.startswith("//"), F.concat(bscheme, F.lit(":"), h))
        .when(hpath == "", no_path)
        .otherwise(resolved)
    )
