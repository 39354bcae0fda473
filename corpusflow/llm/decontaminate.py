"""Benchmark decontamination by a prefix-filtered join.

A benchmark item's windows (``WINDOW`` words, a shorter item is one window) must occur word by
word, so one token of a window is necessary: its rarest shingle, by the count of the benchmark's
shingles over all documents. Documents are joined on that prefix token only; the token's
offset fixes where the window would lie (positional bound), it must lie within the document
(length bound), and its words are compared exactly. Documents are read once: a bit map of the benchmark's
hashes thins out their positions, a join on the hash itself keeps those that a shingle has, with the words
around them, and both the counts and the prefix join work on these.

Defined results: null and word-less texts have no words and no hits; items without words have no
window; equal windows of several items count for each of them; items with a null id hit but
aren't listed; repeated rows get equal results (documents are told apart by id and text); empty
tables give no hits or no rows. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fixed, prepare, shingle_hash, stored, word_array, word_hashes, word_string

WINDOW = 13
SHINGLE = 5
#: 64-bit words of the bit map: some 64 bits a shingle, at most MAP_MOST, as the plan carries it. A fuller map only lets
#: more positions through to the join.
MAP_LEAST, MAP_MOST = 16_384, 131_072


def windows(benchmark: DataFrame) -> DataFrame:
    """``(window_id, words, len, items)``, a row for each distinct window."""
    items = fixed(benchmark.select("item_id", "text"), words=word_array(word_string(F.col("text")))).where("size(words) > 0")
    span = F.least(F.size("words"), F.lit(WINDOW))
    cut = items.select("item_id", span.alias("len"), "words", F.explode(F.sequence(F.lit(0), F.size("words") - span)).alias("at"))
    cut = cut.select("item_id", F.slice("words", F.col("at") + 1, F.col("len")).alias("words"), "len")
    return cut.groupBy("words", "len").agg(F.collect_set(F.col("item_id").cast("string")).alias("items")).withColumn("window_id", F.sha2(F.concat_ws(" ", "words"), 256))


def _shingles(wins: DataFrame, ks: list[int]) -> DataFrame:
    """``(window_id, off, h)`` of every window."""
    parts = None
    for k in ks:
        own = wins.where(F.least("len", F.lit(SHINGLE)) == k)
        part = own.select("window_id", "words", F.explode(F.sequence(F.lit(0), F.col("len") - k)).alias("off")).select("window_id", "off", shingle_hash(word_hashes(F.col("words")), F.col("off"), k).alias("h"))
        parts = part if parts is None else parts.union(part)
    return parts


def _bit_map(hashes: DataFrame) -> tuple[Column, int]:
    """A literal array of longs with a bit set for each hash, and its size."""
    words = MAP_LEAST
    n = hashes.count()
    while words < min(n, MAP_MOST):
        words *= 2
    slot = F.shiftright("h", 6).bitwiseAND(F.lit(words - 1)).cast("int")
    rows = hashes.select(slot.alias("slot"), F.expr("shiftleft(1L, cast(h & 63 as int))").alias("bit")).groupBy("slot").agg(F.expr("bit_or(bit)").alias("bits"))
    bits = [0] * words
    for r in rows.collect():  # at most ``words`` rows
        bits[r["slot"]] = r["bits"]
    return F.expr("cast(split('" + ",".join(map(str, bits)) + "', ',') as array<bigint>)"), words


def _positions(hashes: Column, bits: Column, words: int, ks: list[int]) -> Column:
    """Positions whose shingle hash (from the words' hashes) has its bit set: an array of (pos, h)."""

    def slot(x: Column) -> Column:
        return F.shiftright(x["h"], 6).bitwiseAND(F.lit(words - 1)).cast("int") + 1

    def found(k: int) -> Column:
        places = F.when(F.size(hashes) >= k, F.sequence(F.lit(0), F.size(hashes) - k)).otherwise(F.array().cast("array<int>"))
        hashed = F.transform(places, lambda i: F.struct(i.alias("pos"), shingle_hash(hashes, i, k).alias("h")))
        return F.filter(hashed, lambda x: F.getbit(F.element_at(bits, slot(x)), x["h"].bitwiseAND(F.lit(63)).cast("int")) == 1)

    return F.concat(*[found(k) for k in ks])


def hits(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs(doc_id, text, ..)`` to a row for each distinct (doc_id, text): doc_id, text_key,
    times (rows it stands for), n_words, spans (array of (at, len) of occurring windows), items."""
    prepare(docs.sparkSession)
    base = fixed(docs.select("doc_id", "text"), words=word_array(word_string(F.col("text"))))
    base = fixed(base, hashes=word_hashes(F.col("words"))).select("doc_id", F.coalesce(F.xxhash64("text", F.length("text")), F.lit(0)).alias("text_key"), "words", "hashes")
    wins = stored(windows(benchmark), "windows")
    ks = sorted(r["k"] for r in wins.select(F.least("len", F.lit(SHINGLE)).alias("k")).distinct().collect())  # at most SHINGLE rows
    if not ks:
        none = base.select("doc_id", "text_key", F.size("words").cast("long").alias("n_words"))
        return none.groupBy("doc_id", "text_key").agg(F.count("*").alias("times"), F.max("n_words").alias("n_words")).select(
            "*", F.expr("cast(array() as array<struct<at:int,len:int>>)").alias("spans"), F.expr("cast(array() as array<string>)").alias("items"))
    shingles = stored(_shingles(wins, ks), "shingles")
    wanted = stored(shingles.select("h").distinct(), "wanted")
    bits, size = _bit_map(wanted)
    context = lambda x: F.slice(F.col("words"), F.greatest(x["pos"] - (WINDOW - 1), F.lit(0)) + 1, 2 * WINDOW)
    marked = F.transform(_positions(F.col("hashes"), bits, size, ks), lambda x: F.struct(x["pos"].alias("pos"), x["h"].alias("h"), context(x).alias("context")))
    # a row for the document itself, its hash only spreads these rows in the join
    whole = F.array(F.struct(F.lit(-1).alias("pos"), F.xxhash64("doc_id", "text_key").alias("h"), F.lit(None).cast("array<string>").alias("context")))
    rows = base.select("doc_id", "text_key", F.size("words").cast("long").alias("n_words"), F.inline(F.concat(whole, marked)))
    rows = rows.join(wanted.withColumn("wanted", F.lit(True)), "h", "left").where("pos = -1 or wanted").drop("wanted")
    rows = stored(rows, "found")
    # the necessary prefix: each window's rarest shingle
    counts = rows.where("pos >= 0").groupBy("h").agg(F.count("*").alias("n"))
    rarest = shingles.join(counts, "h").groupBy("window_id").agg(F.min(F.struct("n", "h", "off")).alias("one"))
    prefix = stored(rarest.select("window_id", "one.h", "one.off").join(wins, "window_id"), "prefix")
    met = rows.where("pos >= 0").join(prefix.withColumnsRenamed({"words": "window"}), "h")
    at = F.col("pos") - F.col("off")
    begins = F.greatest(F.col("pos") - (WINDOW - 1), F.lit(0))
    inside = (at >= 0) & (at + F.col("len") <= F.col("n_words"))
    same = F.when(inside, F.slice("context", at - begins + 1, F.col("len")) == F.col("window")).otherwise(F.lit(False))
    met = met.where(F.coalesce(same, F.lit(False))).unionByName(rows.where("pos = -1"), allowMissingColumns=True)
    span = F.when(F.col("pos") >= 0, F.struct(at.cast("int").alias("at"), F.col("len").cast("int").alias("len")))
    return met.groupBy("doc_id", "text_key").agg(
        F.count(F.when(F.col("pos") == -1, 1)).alias("times"), F.max("n_words").alias("n_words"),
        F.array_sort(F.collect_set(span)).alias("spans"), F.array_distinct(F.flatten(F.collect_set("items"))).alias("items"),
    )


def _covered() -> Column:
    """Words inside any span (spans ascend)."""
    start = F.struct(F.lit(0).alias("upto"), F.lit(0).alias("n"))

    def add(acc: Column, s: Column) -> Column:
        end = s["at"] + s["len"]
        return F.struct(F.greatest(acc["upto"], end).alias("upto"), (acc["n"] + F.greatest(end - F.greatest(acc["upto"], s["at"]), F.lit(0))).alias("n"))

    return F.aggregate("spans", start, add, lambda acc: acc["n"]).cast("long")


def _contaminated(n_hit: Column) -> Column:
    return (n_hit > 0) & (20 * n_hit >= F.col("n_words"))


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``(doc_id, n_words, n_hit, n_items, items_sha256, contaminated, spans)`` for each row of ``docs``."""
    found = hits(docs, benchmark).withColumn("n_hit", _covered())
    rows = found.select("*", F.explode(F.array_repeat(F.lit(1), F.col("times").cast("int"))).alias("nth"))
    return rows.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"), _contaminated(F.col("n_hit")).alias("contaminated"), "spans",
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without contaminated rows; columns stay as they are."""
    found = hits(docs, benchmark).withColumn("n_hit", _covered()).where(_contaminated(F.col("n_hit")))
    bad = stored(found.select(F.col("doc_id").alias("bad_id"), "text_key"), "contaminated")
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"))
    key = F.coalesce(F.xxhash64("row.text", F.length("row.text")), F.lit(0))
    return rows.join(bad, F.col("row.doc_id").eqNullSafe(bad["bad_id"]) & (key == bad["text_key"]), "left_anti").select("row.*")
