"""Toxicity by compression distance.

Two zstandard dictionaries are trained: one on ordinary text, one on what is significantly
commoner in toxic text, layered on the ordinary one so that both know everyday wording. A text's
words that are everyday in both classes are skipped, the rest is cut into overlapping windows,
and each window is compressed with either dictionary. Bytes saved by the toxic dictionary, over
the text's windows, give the score; thresholds are calibrated on documents that the
dictionaries have not seen (two-fold).

The fit uses a bounded sample of labelled rows (``FitBounds``); every text is scored whole.

Defined results: null, empty and word-less texts have no window and get the score of one
without evidence; if either class has no labelled document every score is 0; unlabelled, null
and repeated labels: null ``toxic`` is dropped, of repeated labels the largest counts; repeated
rows get equal scores; an empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import new_key, once, prepare


@dataclass(frozen=True)
class FitBounds:
    """Bound of the labelled sample (the first in hash order) and sizes of what is fitted."""

    toxic_docs: int = 2_000
    ordinary_docs: int = 4_000
    chars: int = 32_768  # longer documents are scored, not sampled
    ordinary_bytes: int = 65_536
    toxic_bytes: int = 4_096
    window: int = 48


@dataclass
class Model:
    ordinary: bytes = b""
    toxic: bytes = b""
    everyday: frozenset = frozenset()
    weights: list = field(default_factory=list)
    window: int = 48


# letters A-Z lower-cased, other ASCII to blanks, bytes from 0x80 kept
_FOLD = bytes(c if 97 <= c <= 122 or c >= 128 else c + 32 if 65 <= c <= 90 else 32 for c in range(256))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_FOLD).split()


def windows_of(words: list[bytes], everyday: frozenset, width: int) -> list[bytes]:
    """Half-overlapping windows over the words that aren't everyday ones; fewer bytes than a window
    are repeated to fill one (zstandard stores very short input as it is)."""
    rest = b" ".join([w for w in words if w not in everyday])
    if not rest:
        return []
    rest = b" " + rest + b" "
    if len(rest) < width:
        rest *= -(-width // len(rest))
    step = width // 2
    return [rest[at : at + width] for at in range(0, max(1, len(rest) - step), step)]


def _compressor(content: bytes):
    import zstandard as zs

    params = zs.ZstdCompressionParameters(
        compression_level=1, format=zs.FORMAT_ZSTD1_MAGICLESS, write_content_size=0, write_checksum=0, write_dict_id=0,
        min_match=4, strategy=zs.STRATEGY_GREEDY, window_log=17, hash_log=17, chain_log=17, search_log=6, target_length=0,
    )
    known = zs.ZstdCompressionDict(content, dict_type=zs.DICT_TYPE_RAWCONTENT)
    known.precompute_compress(compression_params=params)
    return zs.ZstdCompressor(dict_data=known, compression_params=params).compress


class Scorer:
    """A model ready for use in one process."""

    N_FEATURES = 6

    def __init__(self, model: Model):
        self.model = model
        if model.ordinary or model.toxic:
            self.ordinary, self.toxic = _compressor(model.ordinary), _compressor(model.ordinary + model.toxic)

    def features(self, text: str | None) -> np.ndarray:
        windows = windows_of(words_of(text), self.model.everyday, self.model.window)
        if not windows:
            return np.array([1.0, 0, 0, 0, 0, 0])
        ordinary, toxic = self.ordinary, self.toxic
        saved = np.fromiter((len(ordinary(w)) - len(toxic(w)) for w in windows), dtype=np.float64, count=len(windows))
        saved[::-1].sort()
        strong = np.maximum(saved - 3, 0)
        return np.array([1.0, min(saved[0], 12) / 4, saved[:3].mean() / 4, saved.mean(), min(strong.mean(), 4), math.log1p(strong.sum()) / 2])

    def score(self, text: str | None) -> float:
        if not self.model.weights:
            return 0.0
        z = float(self.features(text) @ np.array(self.model.weights))
        return 1.0 / (1.0 + math.exp(-max(-30.0, min(30.0, z))))


def _dictionaries(toxic: list[list[bytes]], ordinary: list[list[bytes]], bounds: FitBounds) -> Model:
    """Everyday words, and both dictionaries' contents, from documents as word lists."""
    import zstandard as zs

    in_toxic, in_ordinary = Counter(w for d in toxic for w in set(d)), Counter(w for d in ordinary for w in set(d))
    ratio = len(ordinary) / len(toxic)
    least = max(2.8, min(5.0, math.sqrt(0.016 * len(toxic))))

    def surplus(w: bytes) -> float:
        a, b = in_toxic[w], in_ordinary[w] / ratio
        return (a - b) / math.sqrt(a + b)

    distinctive = sorted((w for w in in_toxic if surplus(w) >= least), key=lambda w: (in_toxic[w], w))
    known = set(distinctive)
    everyday = frozenset(w for w in in_toxic if in_toxic[w] >= 2 and in_ordinary[w] >= 2 and w not in known)
    samples = [x for d in ordinary for x in windows_of([w for w in d if w not in known], everyday, 4 * bounds.window)]
    try:
        content = zs.train_dictionary(bounds.ordinary_bytes, samples, k=48, d=6).as_bytes()
    except zs.ZstdError:  # too little text for the trainer: the text itself
        content = b"".join(samples)[-bounds.ordinary_bytes :]
    # as the trainer orders segments: the commonest last, where offsets are shortest
    return Model(content, b"".join(b" " + w + b" " for w in distinctive)[-bounds.toxic_bytes :], everyday, [], bounds.window)


def _logistic(x: np.ndarray, y: np.ndarray, w: np.ndarray, ridge: float = 0.05) -> np.ndarray:
    beta = np.zeros(x.shape[1])
    penalty = ridge * np.eye(x.shape[1])
    penalty[0, 0] = 1e-6
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        gradient = x.T @ (w * (y - p)) - penalty @ beta
        step = np.linalg.solve((x * (w * p * (1 - p))[:, None]).T @ x + penalty, gradient)
        beta += np.clip(step, -4, 4)
        if np.abs(step).max() < 1e-8:
            break
    return beta


def fit(texts: list[str], toxic: list[int], shares: tuple[float, float] | None = None, bounds: FitBounds = FitBounds()) -> Model:
    """Dictionaries from all given rows, weights from two-fold scores. ``shares``: how many
    rows of class 0 and 1 each sampled row stands for."""
    rows = sorted({(t or ""): int(y) for t, y in zip(texts, toxic)}.items())
    docs = [(words_of(t), t, y) for t, y in rows]
    own = {y: [d for d in docs if d[2] == y] for y in (0, 1)}
    if not own[0] or not own[1]:
        return Model()
    final = _dictionaries([d[0] for d in own[1]], [d[0] for d in own[0]], bounds)
    x, y = [], []
    for fold in (0, 1):
        seen = {c: [d[0] for i, d in enumerate(own[c]) if i % 2 != fold] or [d[0] for d in own[c]] for c in (0, 1)}
        scorer = Scorer(_dictionaries(seen[1], seen[0], bounds))
        for c in (0, 1):
            for i, d in enumerate(own[c]):
                if i % 2 == fold:
                    x.append(scorer.features(d[1]))
                    y.append(c)
    y = np.array(y, dtype=float)
    each = shares or (1.0, 1.0)
    w = np.where(y == 1, each[1], each[0])
    final.weights = _logistic(np.array(x), y, w / w.mean()).tolist()
    return final


def held_out(doc_id: Column) -> Column:
    """Whether crc32 of the id's text is divisible by 5; a null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def fit_on_labels(docs: DataFrame, labels: DataFrame, bounds: FitBounds = FitBounds()) -> Model:
    """Fit on the labelled documents that aren't held out, sampled in hash order."""
    known = labels.where("toxic is not null and doc_id is not null").groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    known = known.where(~held_out(F.col("doc_id")))
    short = docs.select("doc_id", "text").where((F.length("text") <= bounds.chars) & F.col("doc_id").isNotNull())
    totals = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count("*").alias("n")).where("toxic in (0, 1)").collect()}
    drawn = None
    for value, most in ((0, bounds.ordinary_docs), (1, bounds.toxic_docs)):
        part = known.where(F.col("toxic") == value).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
        drawn = part if drawn is None else drawn.union(part)
    # at most toxic_docs + ordinary_docs ids
    rows = short.join(F.broadcast(drawn), "doc_id").select("text", "toxic").collect()
    counts = Counter(r["toxic"] for r in rows)
    shares = tuple(totals.get(c, 0) / max(1, counts[c]) for c in (0, 1))
    return fit([r["text"] for r in rows], [r["toxic"] for r in rows], shares, bounds)


def score_column(docs: DataFrame, model: Model, text: str = "text") -> Column:
    """The score (0 to 1) of a text column under ``model``, broadcast to the workers (bounded by
    ``FitBounds``)."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    key = new_key()

    @F.pandas_udf("double")
    def scores(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = once(key, lambda: Scorer(sent.value))
        for part in parts:
            yield pd.Series([scorer.score(t) for t in part], dtype="float64")

    return scores(docs[text])


def toxicity(docs: DataFrame, labels: DataFrame, bounds: FitBounds = FitBounds()) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` for each row of ``docs``."""
    prepare(docs.sparkSession)
    rows = docs.select("doc_id", "text")
    model = fit_on_labels(rows, labels, bounds)
    scored = rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score_column(rows, model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def drop_toxic(docs: DataFrame, labels: DataFrame, bounds: FitBounds = FitBounds(), least: float = 0.5) -> DataFrame:
    """``docs`` without the rows that score ``least`` or more; columns stay as they are."""
    prepare(docs.sparkSession)
    model = fit_on_labels(docs, labels, bounds)
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), docs["text"].alias("text"))
    return rows.withColumn("score", score_column(rows, model)).where(F.col("score") < least).select("row.*")
