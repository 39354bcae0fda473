"""Periodic runs of words by a dictionary of basic factors.

Per power-of-two length L every stretch of L words gets a name: equal stretches of one text share a
name, and the names of length 2L come from the pairs of names L apart. A place whose next place of
the same name lies at most L on (both occurrences fit into 2L words) starts an arithmetic
progression of occurrences, whose step is proposed as a period. Neighbouring places with the same
step are one proposal; it is extended word by word on both sides and repeated proposals go. Step d is
looked at where L/2 < d <= L: there the name's next occurrence inside a run of period d is exactly d on, so the
step is the smallest period.

A run has at least ``times`` periods and ``least`` words, and no neighbouring word extends it. In such a run
every shorter name occurs at least three times, so places of rarer names are left out of the next length.

One task holds a batch of whole texts and arrays in proportion to their words; nothing is shuffled.

Defined results: a null, empty or word-less text has no runs and collapses to the empty text; a text
without runs collapses to its words joined by single blanks; repeated rows get equal results; a null
``doc_id`` stays null; an empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SPACE_RUN, fixed, prepare

#: A run has so many words and so many periods at least.
LEAST, TIMES = 6, 4
RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
SCHEMA = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"


def find_runs(words: np.ndarray, text: np.ndarray, least: int = LEAST, times: int = TIMES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first place, place after the last, period) of every run, by first place, then period.
    ``words`` are the word numbers of all texts on end and ``text`` each place's text number,
    ascending; no run crosses texts. ``times`` is 4 or more."""
    if times < 4:
        raise ValueError("runs of fewer than four periods need not show three occurrences a name")
    n = len(words)
    none = np.empty(0, np.int64)
    if not n:
        return none, none, none
    longest = int(np.bincount(text).max())
    at = np.arange(n)  # the places still looked at
    key = text.astype(np.int64) * (int(words.max()) + 1) + words
    named = np.full(n, -1)  # name by place, -1 outside ``at``
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    length = 1
    while len(at) and (length // 2 + 1) * times <= longest:
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        same = ordered[1:] == ordered[:-1]
        name = np.concatenate(([0], np.cumsum(~same)))
        step = np.zeros(len(at), np.int64)  # to the next place of the name, 0: none
        placed = at[order]
        step[order[:-1]] = np.where(same, placed[1:] - placed[:-1], 0)
        _propose(at, step, length, words, text, found)
        often = np.bincount(name)[name] >= 3
        keep = np.zeros(len(at), bool)
        keep[order] = often
        names = np.empty(len(at), np.int64)
        names[order] = name
        at, names = at[keep], names[keep]
        # names of twice the length: pairs of names, both kept and in one text
        named[at] = names
        ahead = at + length
        inside = ahead < n
        inside[inside] = (named[ahead[inside]] >= 0) & (text[ahead[inside]] == text[at[inside]])
        key = names[inside] * n + named[ahead[inside]]
        named[at] = -1
        at = at[inside]
        length *= 2
    if not found:
        return none, none, none
    start, end, period = (np.concatenate(x) for x in zip(*found))
    good = end - start >= np.maximum(least, times * period)
    unique = np.unique(np.stack([start[good], period[good], end[good]], axis=1), axis=0)
    return unique[:, 0], unique[:, 2], unique[:, 1]


def _propose(at: np.ndarray, step: np.ndarray, length: int, words: np.ndarray, text: np.ndarray, found: list) -> None:
    """Add the extended proposals (first place, place after the last, period) of one factor length."""
    near = (step <= length) & (step > length // 2)
    at, step = at[near], step[near]
    if not len(at):
        return
    # a progression has three terms at least: the next place has the same step
    i = np.searchsorted(at, at + step)
    i[i == len(at)] = 0
    three = (at[i] == at + step) & (step[i] == step)
    at, step = at[three], step[three]
    if not len(at):
        return
    cut = np.flatnonzero((np.diff(at) != 1) | (np.diff(step) != 0)) + 1
    first, last = np.concatenate(([0], cut)), np.concatenate((cut, [len(at)])) - 1
    start, period = at[first], step[first]
    end = at[last] + 2 * period + length
    n = len(words)
    for _ in range(n):
        left = np.maximum(start - 1, 0)
        grow = (start > 0) & (text[left] == text[start]) & (words[left] == words[left + period])
        if not grow.any():
            break
        start = start - grow
    for _ in range(n):
        right = np.minimum(end, n - 1)
        grow = (end < n) & (text[right] == text[start]) & (words[right] == words[right - period])
        if not grow.any():
            break
        end = end + grow
    found.append((start, end, period))


class _Numbers(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


def _batch(texts: list[bytes | None], least: int, times: int) -> tuple[list[int], pa.Array, list[bytes]]:
    """(number of words, runs, collapsed text) of each text."""
    split = [(t or b"").split() for t in texts]  # bytes: ASCII white space only
    sizes = np.array([len(w) for w in split], np.int64)
    starts = np.concatenate(([0], np.cumsum(sizes)))
    number = _Numbers().__getitem__
    words = np.concatenate([np.fromiter(map(number, w), np.int64, len(w)) for w in split]) if split else np.empty(0, np.int64)
    text = np.repeat(np.arange(len(split)), sizes)
    start, end, period = find_runs(words, text, least, times)
    owner = text[start] if len(start) else np.empty(0, np.int64)
    bounds = np.searchsorted(owner, np.arange(len(split) + 1))
    fields = [pa.array(start - starts[owner], pa.int64()), pa.array(end - start, pa.int64()), pa.array(period, pa.int64())]
    runs = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.StructArray.from_arrays(fields, fields=list(RUN)))
    # words after a run's first period go
    level = np.zeros(len(words) + 1, np.int64)
    np.add.at(level, start + period, 1)
    np.add.at(level, end, -1)
    stays = np.cumsum(level)[:-1] == 0
    out = []
    for k, own in enumerate(split):
        if bounds[k] != bounds[k + 1]:
            own = [w for w, x in zip(own, stays[starts[k] : starts[k + 1]].tolist()) if x]
        out.append(b" ".join(own))
    return sizes.tolist(), runs, out


def periodic_runs(docs: DataFrame, least: int = LEAST, times: int = TIMES) -> DataFrame:
    """``(doc_id, n_words, runs, collapsed)`` for each row of ``docs(doc_id, text, ..)``: all runs by
    start, then period, and the text without the words that repeat a run's first period."""
    prepare(docs.sparkSession)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                n, runs, text = _batch(batch.column("text").to_pylist(), least, times)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n, pa.int64()), runs, pa.array(text, pa.binary()).view(pa.string())], names=["doc_id", "n_words", "runs", "collapsed"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text")).mapInArrow(task, SCHEMA)


# ---- what the query adds ------------------------------------------------------------------


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """``(doc_id, text)`` where the words of every tenth document (by CRC-32 of its id) repeat from a
    place on with a period, both drawn from the CRC-32. A document without id keeps its text."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    chosen = (h % 10 == 0) & F.col("text").isNotNull()
    flat = F.trim(F.regexp_replace("text", SPACE_RUN, " "))
    rows = fixed(docs.select("doc_id", "text"), g=F.floor(h / 10), words=F.when(chosen, F.filter(F.split(flat, " "), lambda w: w != "")))
    n = F.size("words").cast("long")  # -1 without words
    rows = fixed(rows, a=F.when(n > 0, F.col("g") % n))
    p = F.floor((n - F.col("a")) / (F.col("g") % 8 + 3)) + 1
    rows = fixed(rows, p=p)
    source = lambda i: F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p"))
    repeated = F.array_join(F.transform("words", lambda _, i: F.get("words", source(i).cast("int"))), " ")
    return rows.select("doc_id", F.when(F.col("a").isNotNull(), repeated).otherwise(F.col("text")).alias("text"))


def run_summary(found: DataFrame) -> DataFrame:
    """Counts, the run of the greatest exponent and digests of :func:`periodic_runs`."""
    none = F.lit(None).cast("struct<start:long,length:long,period:long>")
    # exact comparison of length / period; runs come by start, then period, so ties keep the first
    best = F.aggregate("runs", none, lambda b, r: F.when(b.isNull() | (r["length"] * b["period"] > b["length"] * r["period"]), r).otherwise(b))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n"))), "")
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.inline(F.array(best)),
        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    ).selectExpr("doc_id", "n_runs", "start", "length", "period", "1000 * length div period as exponent_milli", "runs_sha256", "collapsed_sha256")
