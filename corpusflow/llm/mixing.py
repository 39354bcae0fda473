"""Mixing sources to target weights by Pareto order sampling.

Sources share ``share`` times all words by weight; a target stops at ``most`` times its source's
size and the excess is shared again (one water level, found over the sources sorted by where
they fill up). A source whose target is r times its size takes floor(r) certain whole copies of
each document; the rest is a Pareto sample of unequal inclusion probabilities: p = min(1, scale * size),
with the scale at which the expected words, sum(p * size), fill the remainder, so the remainder comes from
few documents and long ones are likelier. Documents are ranked by random odds divided by inclusion odds,
and the first ones whose words fit the remainder are taken. Only a document of more words than the whole
remainder has no chance of the extra copy: the source would pass its target with it. Later rounds fill the
gap that the first document too many leaves, so a source's words stay within a small document of its target.

The random number is a hash of (doc_id, source, size) and a ``seed``, so reruns agree. Ranks are cut through
a histogram of ranks by source and only the bin at the cut is sorted: no source's rows meet in
one task.

Defined results: a null or word-less text has size 0 and takes 0 words; a null source is a source
of its own, last; rows that agree in id, source and size share a rank and are taken together
(or not at all); a source without words has target 0; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACE_RUN, fixed, prepare, stored

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2
#: Bins of the histogram of ranks; a source's rows in one bin are sorted together.
BINS = 4_096
#: Rounds of filling.
ROUNDS = 4


def word_count(text: Column) -> Column:
    """Number of runs of non-white characters."""
    flat = F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), SPACE_RUN, " "))
    return F.when(flat == "", F.lit(0)).otherwise(F.length(flat) - F.length(F.replace(flat, F.lit(" "), F.lit(""))) + 1).cast("long")


def uniform(*cols: Column) -> Column:
    """A number within (0, 1) from a hash of ``cols``: 52 bits of MD5."""
    digest = F.md5(F.concat_ws("|", *[c.cast("string") for c in cols]).cast("binary"))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / float(2**52)


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """``sizes(source, size)`` to ``(source, source_size, target)``. One row a source from the first
    step on, so the windows without a key sort sources, not documents."""
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(order) - 1) % len(weights)
    weighed = sources.withColumn("weight", F.element_at(F.array(*[F.lit(w) for w in weights]), (turn + 1).cast("int")).cast("long")).withColumn("cap", F.col("source_size") * most)
    fill = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    total = F.sum("source_size").over(Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    full_before = F.coalesce(F.sum("cap").over(fill.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    weight_left = F.sum("weight").over(fill.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    levels = weighed.withColumn("level", (total * share - full_before) / weight_left)
    level = F.max("level").over(Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return levels.select("source", "source_size", F.least(F.col("cap").cast("double"), level * F.col("weight")).alias("target"))


def _bin(rank: Column) -> Column:
    return F.least(F.floor(rank / (rank + 1) * BINS), F.lit(BINS - 1)).cast("int")


def inclusion(size: Column, scale: Column) -> Column:
    """A document's inclusion probability."""
    return F.least(F.lit(1.0), scale * size)


def scales(fitting: DataFrame) -> DataFrame:
    """``fitting(source, size, room)``, documents that fit their source's room, to ``(source, scale)``.

    With the documents over a size certain, the scale is (room - their words) / (the others' squared sizes); the
    words expected are the least over all such cuts, so the scale is the largest. The window sorts
    the distinct sizes of a source, at most as many as its longest document has words. Sums are exact numbers:
    reruns agree whatever the order."""
    sizes = fitting.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n"), F.first("room").alias("room"))
    words = (F.col("n") * F.col("size")).cast("decimal(19,0)")
    down = Window.partitionBy("source").orderBy(F.col("size").desc())
    larger = F.coalesce(F.sum("words").over(down.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    squares = F.sum(F.col("words") * F.col("size").cast("decimal(18,0)")).over(down.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    levels = sizes.withColumn("words", words).select("source", "room", "words", ((F.col("room") - larger.cast("double")) / squares.cast("double")).alias("scale"))
    by_source = levels.groupBy("source").agg(F.max("scale").alias("scale"), F.sum("words").cast("double").alias("words"), F.first("room").alias("room"))
    return by_source.select("source", F.when(F.col("words") <= F.col("room"), 1.0).otherwise(F.col("scale")).alias("scale"))


def _pareto(u: Column, p: Column) -> Column:
    """Random odds divided by inclusion odds."""
    return F.when(p > 0, u / (1 - u) * ((1 - p) / p)).otherwise(F.lit(float("inf")))


def cuts(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST, rounds: int = ROUNDS) -> DataFrame:
    """``sized(source, size, u)`` to a row a source: source_size, target, copies (certain), scale
    (of the inclusion probabilities of those that fit) and ``rounds``, an array of (room, last_bin, last_rank):
    a round takes those of at most ``room`` words after the round before, up to its last."""
    plan = targets(sized, weights, share, most)
    ratio = F.col("target") / F.col("source_size")
    plan = plan.withColumn("copies", F.when(F.col("source_size") > 0, F.floor(ratio)).otherwise(0).cast("int"))
    plan = plan.withColumn("room", F.col("target") - F.col("copies") * F.col("source_size"))
    plan = stored(plan, "targets")
    scaled = scales(_on_source(sized, plan).where("size > 0 and size <= room").select("source", "size", "room"))
    same = plan.alias("a").join(scaled.alias("b"), F.col("a.source").eqNullSafe(F.col("b.source")), "left")
    plan = same.select("a.*", F.coalesce("b.scale", F.lit(0.0)).alias("scale"))
    empty = F.array().cast("array<struct<room:double,last_bin:int,last_rank:double>>")
    plan = plan.withColumn("rounds", empty).withColumn("last_bin", F.lit(-1)).withColumn("last_rank", F.lit(-1.0))
    for _ in range(rounds):
        plan = stored(plan, "cuts")
        rows = _on_source(sized, plan).withColumn("p", inclusion(F.col("size"), F.col("scale"))).withColumn("rank", _pareto(F.col("u"), F.col("p"))).withColumn("bin", _bin(F.col("rank")))
        after = (F.col("bin") > F.col("last_bin")) | ((F.col("bin") == F.col("last_bin")) & (F.col("rank") > F.col("last_rank")))
        rows = rows.where((F.col("size") <= F.col("room")) & (F.col("p") > 0) & after).select("source", "size", "rank", "bin", "room")
        by_bin = rows.groupBy("source", "bin").agg(F.sum("size").alias("words"), F.first("room").alias("room"))
        upto = F.sum("words").over(Window.partitionBy("source").orderBy("bin"))  # at most BINS rows a source
        first_over = by_bin.withColumn("upto", upto).where("upto > room").groupBy("source").agg(F.min(F.struct("bin", (F.col("upto") - F.col("words")).alias("before"))).alias("cut"))
        inside = _on_source(rows, first_over.select("source", "cut.bin", "cut.before").withColumnRenamed("bin", "cut_bin")).where("bin = cut_bin")
        ranked = inside.withColumn("upto", F.col("before") + F.sum("size").over(Window.partitionBy("source").orderBy("rank").rangeBetween(Window.unboundedPreceding, Window.currentRow)))
        ended = ranked.groupBy("source").agg(
            F.first("cut_bin").alias("new_bin"), F.max(F.when(F.col("upto") <= F.col("room"), F.col("rank"))).alias("new_rank"),
            F.greatest(F.max("before"), F.coalesce(F.max(F.when(F.col("upto") <= F.col("room"), F.col("upto"))), F.lit(0))).alias("took"),
        )
        met = plan.alias("a").join(ended.alias("b"), F.col("a.source").eqNullSafe(F.col("b.source")), "left")
        # no bin passes the room: all that fit are taken and nothing is left to take
        new_bin = F.coalesce(F.col("new_bin"), F.lit(BINS))
        new_rank = F.coalesce(F.col("new_rank"), F.lit(-1.0))
        plan = met.select(
            "a.source", "a.source_size", "a.target", "a.copies", "a.scale",
            F.concat(F.col("a.rounds"), F.array(F.struct(F.col("a.room").alias("room"), new_bin.alias("last_bin"), new_rank.alias("last_rank")))).alias("rounds"),
            F.when(F.col("b.took").isNull(), F.lit(0.0)).otherwise(F.col("a.room") - F.col("b.took")).alias("room"),
            new_bin.alias("last_bin"), new_rank.alias("last_rank"),
        )
    return stored(plan.select("source", "source_size", "target", "copies", "scale", "rounds"), "cuts")


def _on_source(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """``rows`` with the columns of ``plan`` for their source (null meets null)."""
    plan = plan.withColumnRenamed("source", "_source")
    return rows.join(plan, rows["source"].eqNullSafe(plan["_source"])).drop("_source")


def _taken(size: Column, rank: Column, rounds: Column) -> Column:
    """Whether a round took the row."""
    bin_ = _bin(rank)

    def upto(r: Column) -> Column:
        return (bin_ < r["last_bin"]) | ((bin_ == r["last_bin"]) & (rank <= r["last_rank"]))

    before = F.lit(None).cast("struct<room:double,last_bin:int,last_rank:double>")
    pairs = F.arrays_zip(rounds.alias("now"), F.concat(F.array(before), rounds).alias("then"))
    fits = lambda x: (size <= x["now"]["room"]) & upto(x["now"]) & (x["then"].isNull() | ~upto(x["then"]))
    return F.coalesce(F.exists(F.slice(pairs, 1, F.size(rounds)), fits), F.lit(False))


def _draw(rows: DataFrame, plan: DataFrame, seed: int) -> DataFrame:
    """``rows(doc_id, source, size, ..)`` with the plan of their source; ``copies`` counts the drawn one too."""
    rows = _on_source(rows, plan).withColumn("p", inclusion(F.col("size"), F.col("scale")))
    rank = _pareto(_random(seed), F.col("p"))
    # documents beyond the first room are in no round
    return rows.withColumn("rank", rank).withColumn("copies", (F.col("copies") + ((F.col("p") > 0) & _taken(F.col("size"), F.col("rank"), F.col("rounds"))).cast("int")).cast("int"))


def _random(seed: int) -> Column:
    return uniform(F.col("doc_id"), F.col("source"), F.col("size"), *([F.lit(seed)] if seed else []))


def _sized(docs: DataFrame, seed: int) -> DataFrame:
    """``(doc_id, source, size, u)`` of the documents."""
    return docs.select("doc_id", "source", word_count(F.col("text")).alias("size")).withColumn("u", _random(seed))


def mix(docs: DataFrame, seed: int = 0, **options) -> DataFrame:
    """``(doc_id, size, source_size, target, taken, copies)`` for each row of ``docs``."""
    prepare(docs.sparkSession)
    sized = stored(_sized(docs.select("doc_id", "source", "text"), seed), "sizes")
    rows = _draw(sized, cuts(sized, **options), seed)
    return rows.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).cast("long").alias("taken"), "copies")


def mixed_documents(docs: DataFrame, seed: int = 0, **options) -> DataFrame:
    """The mix itself: each row of ``docs`` as often as the mix takes it; columns stay as they are."""
    prepare(docs.sparkSession)
    sized = stored(_sized(docs.select("doc_id", "source", "text"), seed), "sizes")
    plan = cuts(sized, **options)
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"))
    rows = _draw(fixed(rows, size=word_count(F.col("row.text")), source=F.col("row.source"), doc_id=F.col("row.doc_id")), plan, seed)
    return rows.select("row", F.explode(F.array_repeat(F.lit(True), F.col("copies"))).alias("taken")).select("row.*")
