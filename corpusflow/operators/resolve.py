"""URL resolution: handler lookup (J1), handler registry and dispatch (X2), top-1 file
choice (W1) and the resolved URL with its fallbacks (J5)."""

from __future__ import annotations

import importlib
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusflow.functions.text import WS
from corpusflow.functions.urls import item_identifier, url_authority, url_quote

# --- fixed values ----------------------------------------------------------------
PDF_SUFFIX = ".pdf"
TEXT_PDF_MARK = "_text.pdf"
SIZE = "decimal(38,0)"
RESOLVER_FUNCTION = "resolve_pdf_url"
#: Handlers that still go into one CASE expression.
MOST_CASES = 100
# ----------------------------------------------------------------------------------


def match_handler(url, handlers: list[tuple[str, str]]) -> Column:
    """Module of the first handler (config order) whose pattern is a substring of the
    URL authority; null when none matches. The handler list is config-sized, so it is
    compiled into one CASE expression (no join, no shuffle)."""
    auth = url_authority(url)
    expr = None
    for pattern, module in handlers:
        cond = auth.contains(F.lit(pattern))
        expr = F.when(cond, F.lit(module)) if expr is None else expr.when(cond, F.lit(module))
    return expr if expr is not None else F.lit(None).cast("string")


def match_handler_many(spark: SparkSession, url, handlers: list[tuple[str, str]]) -> Column:
    """J1 for long handler lists: the same answer as :func:`match_handler`, from sorted hashes of all patterns, in which the
    pieces of an authority that are as long as some pattern are looked up, then compared. The list is broadcast as arrays
    (it is the config's size: about 40 bytes a handler beside its texts); the plan doesn't grow with it."""
    sent = spark.sparkContext.broadcast(_pattern_table(handlers))

    @F.pandas_udf("string")
    def matched(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        table = sent.value
        for part in parts:
            yield table["modules"].take(pa.array(_first_patterns(part, table), pa.int64())).to_pandas()

    return matched(url_authority(url))


_BASE, _INVERSE = 0x9E3779B97F4A7C15, pow(0x9E3779B97F4A7C15, -1, 1 << 64)
#: Bytes of authorities that are looked up at once.
LOOKED_UP = 1 << 18


def _piece_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums and inverse powers from which :func:`_piece_hash` takes the hash of any piece of the bytes."""
    with np.errstate(over="ignore"):
        powers = np.cumprod(np.r_[np.uint64(1), np.full(len(data), _BASE, dtype=np.uint64)])
        inverse = np.cumprod(np.r_[np.uint64(1), np.full(len(data), _INVERSE, dtype=np.uint64)])
        value = (data.astype(np.uint64) + np.uint64(1)) * np.uint64(0xBF58476D1CE4E5B9)
        value = (value ^ (value >> np.uint64(29))) * powers[:-1]
        return np.r_[np.uint64(0), np.cumsum(value)], inverse


def _piece_hash(sums: np.ndarray, inverse: np.ndarray, start: np.ndarray, length) -> np.ndarray:
    """A 64-bit hash of the pieces from ``start`` on; equal pieces have equal ones wherever they stand."""
    with np.errstate(over="ignore"):
        h = (sums[start + length] - sums[start]) * inverse[start] + np.asarray(length, dtype=np.uint64) * np.uint64(_BASE)
        h = (h ^ (h >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)
        return h ^ (h >> np.uint64(29))


def _pattern_table(handlers: list[tuple[str, str]]) -> dict:
    """Arrays of a handler list: each pattern's hash, sorted, its bytes and its first place; the modules."""
    first: dict[str, int] = {}
    for i, (pattern, _) in enumerate(handlers):
        first.setdefault(pattern, i)
    always = first.pop("", -1)
    texts = [p.encode("utf-8", "surrogatepass") for p in first]
    place = np.fromiter(first.values(), dtype=np.int64, count=len(texts))
    length = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
    data = np.frombuffer(b"".join(texts), dtype=np.uint8)
    start = np.cumsum(length) - length
    hashes = _piece_hash(*_piece_hashes(data), start, length)
    order = np.argsort(hashes, kind="stable")
    known = np.zeros(1 << max(10, 3 + len(texts).bit_length()), dtype=bool)  # whether a hash may be among them
    known[hashes & np.uint64(len(known) - 1)] = True
    return {
        "hashes": hashes[order], "place": place[order], "start": start[order], "length": length[order], "lengths": np.unique(length).tolist(),
        "bytes": data, "known": known, "always": always, "modules": pa.array([m for _, m in handlers], pa.string()),
    }


def _first_patterns(authorities: pd.Series, table: dict) -> list[int | None]:
    """The place of the first pattern in each authority, or None."""
    texts = [None if a is None else a.encode("utf-8", "surrogatepass") for a in authorities]
    out, at = [], 0
    while at < len(texts):
        end, size = at, 0
        while end < len(texts) and (end == at or size + len(texts[end] or b"") <= LOOKED_UP):
            size += len(texts[end] or b"")
            end += 1
        out += _looked_up(texts[at:end], table)
        at = end
    return out


def _looked_up(texts: list[bytes | None], table: dict) -> list[int | None]:
    data = np.frombuffer(b"".join(t or b"" for t in texts), dtype=np.uint8)
    size = np.fromiter((len(t or b"") for t in texts), dtype=np.int64, count=len(texts))
    row = np.repeat(np.arange(len(texts)), size)
    ends = np.cumsum(size)[row]
    none = len(table["modules"])
    best = np.full(len(texts), none if table["always"] < 0 else table["always"], dtype=np.int64)
    sums, inverse = _piece_hashes(data)
    hashes, known = table["hashes"], table["known"]
    for length in table["lengths"]:
        start = np.flatnonzero(np.arange(len(data)) + length <= ends)
        h = _piece_hash(sums, inverse, start, length)
        may = known[h & np.uint64(len(known) - 1)]
        start, h = start[may], h[may]
        low, high = np.searchsorted(hashes, h, side="left"), np.searchsorted(hashes, h, side="right")
        while len(start := start[low < high]):  # mostly one pattern a hash
            low, high = (x[low < high] for x in (low, high))
            same = table["length"][low] == length
            for k in range(length):
                own = np.flatnonzero(same)
                same[own] = table["bytes"][table["start"][low[own]] + k] == data[start[own] + k]
            np.minimum.at(best, row[start[same]], table["place"][low[same]])
            low = low + 1
    return [None if t is None or b == none else int(b) for t, b in zip(texts, best)]


def match_handler_col(url, handlers_col) -> Column:
    """J1 with the handler list as an array<struct<pattern,module>> column (from the config)."""
    auth = url_authority(url)
    h = F.col(handlers_col) if isinstance(handlers_col, str) else handlers_col
    return F.get(F.filter(h, lambda e: auth.contains(e["pattern"])), 0)["module"]


Resolver = Callable[[DataFrame, str], DataFrame]
ColumnResolver = Callable[[Column], Column]


class HandlerRegistry:
    """Resolvers by module name, chosen per row by J1.

    * column resolvers (``register_column``) map the URL Column to a resolved URL Column
      (null = no answer); all of them compile into one CASE projection — one pass, no
      shuffle;
    * DataFrame resolvers (``register``) map the rows of their handler to the same rows plus
      ``resolved_url`` — for resolvers that need a join (e.g. a metadata table); each adds
      one filtered branch to a union.

    Unknown modules, resolvers that give null and rows without a handler keep the
    original URL."""

    def __init__(self, default: Resolver | None = None):
        """``default`` resolves the rows of every handler without a resolver of its own."""
        self._default = default
        self._frames: dict[str, Resolver] = {}
        self._columns: dict[str, ColumnResolver] = {}

    def register(self, module: str, resolver: Resolver) -> "HandlerRegistry":
        self._frames[module] = resolver
        return self

    def register_column(self, module: str, resolver: ColumnResolver) -> "HandlerRegistry":
        self._columns[module] = resolver
        return self

    def dispatch(self, df: DataFrame, url_col: str, handlers: list[tuple[str, str]] | str) -> DataFrame:
        """``handlers``: the ordered list, or the name of a column that holds each row's own."""
        if isinstance(handlers, str):
            match = match_handler_col(url_col, handlers)
        elif len(handlers) > MOST_CASES:
            match = match_handler_many(df.sparkSession, url_col, handlers)
        else:
            match = match_handler(url_col, handlers)
        tagged = df.withColumn("handler", match)
        url = F.col(url_col)
        expr = None
        for name, fn in self._columns.items():
            cond = F.col("handler") == F.lit(name)
            expr = F.when(cond, fn(url)) if expr is None else expr.when(cond, fn(url))
        col_answer = expr if expr is not None else F.lit(None).cast("string")
        frames = list(self._frames)
        rest = tagged.filter(F.col("handler").isNull() | ~F.col("handler").isin(frames)) if frames else tagged
        parts = []
        if self._default is not None:
            known = [*self._columns]
            others = F.col("handler").isNotNull() & (~F.col("handler").isin(known) if known else F.lit(True))
            others = F.coalesce(others, F.lit(False))
            parts.append(self._default(rest.filter(others), url_col).select(*tagged.columns, "resolved_url"))
            rest = rest.filter(~others)
        parts.insert(0, rest.withColumn("resolved_url", col_answer))
        for name in frames:
            sub = tagged.filter(F.col("handler") == F.lit(name))
            parts.append(self._frames[name](sub, url_col).select(*tagged.columns, "resolved_url"))
        out = reduce(lambda a, b: a.unionByName(b), parts)
        return out.withColumn("resolved_url", F.coalesce(F.col("resolved_url"), url))


# --- X2 by module name ---------------------------------------------------------------


class ModuleResolver:
    """One row for each (module, URL): the module is imported by name and kept, a worker's own, and its
    ``resolve_pdf_url`` called. Whatever goes wrong leaves the URL and says why."""

    def __init__(self):
        self.functions: dict[str, object] = {}

    def _function(self, module: str):
        if module not in self.functions:
            try:
                found = getattr(importlib.import_module(module), RESOLVER_FUNCTION, None)
                self.functions[module] = found or f"module has no {RESOLVER_FUNCTION}"
            except Exception as e:
                self.functions[module] = f"module can't be loaded: {type(e).__name__}"
        return self.functions[module]

    def eval(self, module: str, url: str):
        if module is None:
            yield url, None
            return
        function = self._function(module)
        if isinstance(function, str):
            yield url, function
            return
        try:
            yield function(url) or url, None
        except Exception as e:
            yield url, f"resolver failed: {type(e).__name__}"


def resolve_by_module(df: DataFrame, url_col: str, handler_col: str = "handler") -> DataFrame:
    """X2 from the config alone: ``df`` with ``resolved_url`` and ``resolve_error``. ``handler_col`` names a Python module (null: none) whose
    ``resolve_pdf_url(url)`` gives the URL; modules must be importable on the workers. A missing module or
    function, an exception, and an empty or null answer keep the original URL."""
    resolver = F.udtf(ModuleResolver, returnType="resolved_url string, resolve_error string")
    return df.lateralJoin(resolver(F.col(handler_col).outer(), F.col(url_col).outer()))


# --- W1 / J5 -------------------------------------------------------------------------


def _size(listing: DataFrame) -> Column:
    """A file's size as Python's int() reads it: no such key -> 0; a number is cut; a text must be
    an integer (single underscores between digits); anything else -> null (an error). Python's
    integers have no bound; here 38 digits are kept."""
    text = F.trim(F.regexp_replace(F.col("size"), f"^[{WS}]+|[{WS}]+$", ""))
    whole = F.when(text.rlike("^[+-]?[0-9]+(?:_[0-9]+)*$"), F.replace(text, F.lit("_"), F.lit("")).try_cast(SIZE))
    if "size_json" not in listing.columns:
        return F.when(F.col("size").isNull(), F.lit(0).cast(SIZE)).otherwise(whole)
    raw = F.col("size_json")
    number = raw.try_cast("double")
    # a fraction is cut; from 2^53 on a double is a whole number
    cut = F.when(F.abs(number) < 2**53, F.when(number >= 0, F.floor(number)).otherwise(F.ceil(number)).try_cast(SIZE)).otherwise(number.try_cast(SIZE))
    integer = F.when(raw.rlike("^-?[0-9]+$"), raw.try_cast(SIZE))
    return (
        F.when(raw.isNull(), F.lit(0).cast(SIZE))
        .when(raw.startswith('"'), whole)
        .when(raw == "true", F.lit(1).cast(SIZE))
        .when(raw == "false", F.lit(0).cast(SIZE))
        .when(raw.rlike("^-?[0-9]"), F.coalesce(integer, cut))
    )


def best_file(listing: DataFrame, item_col: str = "item_id") -> DataFrame:
    """One PDF per item. Prefer names without '_text.pdf'; among the ranked set the
    largest int(size) (missing -> 0), ties -> earliest in the listing. A size in the ranked
    set that int() wouldn't read makes the item an error, as does a ``reason`` (of
    :func:`~corpusflow.sources.files.file_listing_with_errors`). One partial aggregation."""
    lname = F.lower(F.col("name"))
    is_pdf = lname.endswith(PDF_SUFFIX)
    is_text = lname.contains(TEXT_PDF_MARK)
    size = _size(listing)
    bad = size.isNull()
    lost = F.col("reason").isNotNull() if "reason" in listing.columns else F.lit(False)
    pdf = listing.filter(is_pdf | lost).select(
        item_col, "pos", "name", is_text.alias("_t"), F.coalesce(size, F.lit(0).cast(SIZE)).alias("_sz"), bad.alias("_bad"), lost.alias("_lost")
    )
    agg = pdf.groupBy(item_col).agg(
        F.count_if(~F.col("_lost")).cast("bigint").alias("n_pdf"),
        F.max("_lost").alias("_lost"),
        F.count_if(~F.col("_t")).alias("_n_main"),
        F.count_if(~F.col("_t") & F.col("_bad")).alias("_bad_main"),
        F.count_if(F.col("_t") & F.col("_bad")).alias("_bad_text"),
        F.min_by(F.col("name"), F.struct(F.col("_t"), -F.col("_sz"), F.col("pos"))).alias("_best"),
    )
    err = F.col("_lost") | F.when(F.col("_n_main") > 0, F.col("_bad_main") > 0).otherwise(F.col("_bad_text") > 0)
    return agg.select(
        item_col,
        "n_pdf",
        F.when(err, F.lit(None).cast("string")).otherwise(F.col("_best")).alias("best_name"),
        err.alias("size_error"),
    )


def resolved_urls(
    catalogue: DataFrame,
    url_col: str,
    best: DataFrame,
    item_col: str,
    download_base: str,
    segment: str = "details",
    errors: DataFrame | None = None,
) -> DataFrame:
    """Catalogue URL -> direct file URL. Chosen PDF -> ``{base}/{id}/{quote(name)}``;
    metadata error (an unreadable size, or an item of ``errors``: its metadata couldn't be
    fetched or read) -> ``{base}/{id}/{id}.pdf``; no identifier or no PDF -> original URL."""
    ident = item_identifier(url_col, segment)
    c = catalogue.withColumn("_ident", ident)
    j = c.join(best, c["_ident"] == best[item_col], "left")
    failed = F.coalesce(F.col("size_error"), F.lit(False))
    if errors is not None:
        lost = errors.select(F.col(item_col).alias("_lost")).distinct()
        j = j.join(lost, F.col("_ident") == F.col("_lost"), "left")
        failed = failed | F.col("_lost").isNotNull()
    chosen = F.concat(F.lit(download_base), F.lit("/"), F.col("_ident"), F.lit("/"), url_quote(F.col("best_name")))
    fallback = F.concat(F.lit(download_base), F.lit("/"), F.col("_ident"), F.lit("/"), F.col("_ident"), F.lit(PDF_SUFFIX))
    resolved = (
        F.when(F.col("_ident").isNull(), F.col(url_col))
        .when(failed, fallback)
        .when(F.col("best_name").isNotNull(), chosen)
        .otherwise(F.col(url_col))
    )
    drop = [x for x in best.columns if x not in catalogue.columns] + ["_ident", "_lost"]
    return j.withColumn("resolved_url", resolved).drop(*drop)


def metadata_resolver(items: DataFrame, download_base: str, segment: str = "details") -> Resolver:
    """A resolver over fetched item metadata (``item_id, metadata``: JSON text, null where the
    fetch failed): S4 listing -> W1 best file -> J5 URL, with J5's fallback for failed items."""
    from corpusflow.sources.files import file_listing_with_errors

    best = best_file(file_listing_with_errors(items, "metadata", ["item_id"]))
    return lambda df, url_col: resolved_urls(df, url_col, best, "item_id", download_base, segment)
