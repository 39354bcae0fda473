"""SimHash near-duplicates over vantage-point shards.

A fingerprint bit is set if more than half of a text's shingle hashes set it; two fingerprints
link when at most ``max_bits`` bits differ. Fingerprints are dealt to shards by a vantage-point
tree: at each node the Hamming distance to the vantage point decides the branch, and by the
triangle inequality only fingerprints within ``max_bits`` below the radius can have a partner
beyond it, so these overlap into the far branch too. Every linked pair meets in a shard.

Defined results: null and word-less texts have fingerprint zero, linked like any other;
repeated rows and equal fingerprints share a component; a null ``doc_id`` gets a fingerprint and
its group's component but never names one (a group of null ids only has a null component).
An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import prepare, stored

SEED = 42
#: Fingerprints drawn (in hash order) to choose vantage points and radii; bounds the tree.
TREE_SAMPLE = 20_000
#: A node with fewer sampled fingerprints, standing for fewer than SHARD_ROWS rows, is a shard.
SHARD_ROWS = 2_000
LEAST_SAMPLE = 16
#: Below this a shard's pairs are compared directly, in blocks.
DIRECT = 1_024


def fingerprint_bytes(text: str | None, shingle: int) -> int:
    """The 64-bit fingerprint of one text (unsigned)."""
    import xxhash

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    digest = xxhash.xxh64_intdigest
    if len(words) < shingle:
        hashes = np.array([digest(b" ".join(words), SEED)], dtype=np.uint64)
    else:
        joined = memoryview(b" ".join(words))
        ends = np.cumsum([len(w) + 1 for w in words]) - 1
        starts = np.concatenate(([0], ends[:-1] + 1)).tolist()
        ends = ends.tolist()
        n = len(words) - shingle + 1
        hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in zip(starts, ends[shingle - 1 :])), dtype=np.uint64, count=n)
    n = len(hashes)
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, n, 65_536):  # bounded memory for very long texts
        bits = np.unpackbits(hashes[at : at + 65_536].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(sum(1 << i for i in np.flatnonzero(2 * counts > n).tolist()))


def fingerprint_column(text: Column, shingle: int = 3) -> Column:
    """The fingerprint as a signed 64-bit column."""

    @F.pandas_udf("long")
    def fingerprints(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in parts:
            made = np.fromiter((fingerprint_bytes(t, shingle) for t in part), dtype=np.uint64, count=len(part))
            yield pd.Series(made.view(np.int64))

    return fingerprints(text)


def hex16(fp: Column) -> Column:
    """16 lowercase hex digits of a signed 64-bit column."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


# ---- the vantage-point tree ---------------------------------------------------------------


def split_radius(distances: np.ndarray, max_bits: int) -> int | None:
    """The radius that makes the larger branch (far with its overlap) smallest. None if a split
    wouldn't pay: a branch would keep over 4/5 of the points, or both together over 3/2 of them
    (a tight cluster, in which direct comparison is cheaper than ever more overlap)."""
    counts = np.bincount(distances, minlength=66)
    below = np.cumsum(counts)
    n = len(distances)
    best, radius = 0.8 * n, None
    for r in range(65):
        near, far = int(below[r]), n - int(below[r - max_bits] if r >= max_bits else 0)
        if max(near, far) < best and near + far <= 1.5 * n:
            best, radius = max(near, far), r
    return radius


def build_tree(sample: np.ndarray, rows_each: float, max_bits: int, shard_rows: int = SHARD_ROWS) -> list[tuple[int, int, int, int]]:
    """Nodes (vantage point, radius, near child, far child); a child of -1-k is shard k."""
    nodes: list[tuple[int, int, int, int]] = []
    shards = 0

    def grow(points: np.ndarray) -> int:
        nonlocal shards
        radius = None
        if len(points) >= LEAST_SAMPLE and len(points) * rows_each > shard_rows:
            vantage = points[0]
            distances = np.bitwise_count(points ^ vantage).astype(np.int64)
            radius = split_radius(distances, max_bits)
        if radius is None:
            shards += 1
            return -shards
        at = len(nodes)
        nodes.append((0, 0, 0, 0))
        near = grow(points[distances <= radius])
        far = grow(points[distances > radius - max_bits])
        nodes[at] = (int(vantage), int(radius), near, far)
        return at

    root = grow(sample)
    return nodes if root == 0 and nodes else []


def route(points: np.ndarray, nodes: list[tuple[int, int, int, int]], max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(indexes into points, shard) for every shard that a point belongs to."""
    if not nodes:
        return np.arange(len(points)), np.zeros(len(points), dtype=np.int64)
    found: list[tuple[np.ndarray, np.ndarray]] = []
    todo = [(0, np.arange(len(points)))]
    while todo:
        node, own = todo.pop()
        if not len(own):
            continue
        if node < 0:
            found.append((own, np.full(len(own), -1 - node, dtype=np.int64)))
            continue
        vantage, radius, near, far = nodes[node]
        distances = np.bitwise_count(points[own] ^ np.uint64(vantage)).astype(np.int64)
        todo.append((near, own[distances <= radius]))
        todo.append((far, own[distances > radius - max_bits]))
    if not found:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def shard_links(points: np.ndarray, max_bits: int) -> np.ndarray:
    """For each of the distinct points the index of its group's first point: groups are what
    links of at most ``max_bits`` bits reach within the shard. The shard's own vantage-point
    tree prunes; blocks of at most DIRECT rows compare directly."""
    group = np.arange(len(points))

    def top(i: int) -> int:
        while group[i] != i:
            group[i] = group[group[i]]
            i = group[i]
        return i

    def join(a: np.ndarray, b: np.ndarray) -> None:
        for x, y in zip(a.tolist(), b.tolist()):
            x, y = top(x), top(y)
            if x != y:
                group[max(x, y)] = min(x, y)

    def direct(own: np.ndarray) -> None:
        mine = points[own]
        for at in range(0, len(own), 512):
            part = mine[at : at + 512]
            near = np.bitwise_count(part[:, None] ^ mine[None, at:]) <= max_bits
            a, b = np.nonzero(near)
            far = b > a
            join(own[at + a[far]], own[at + b[far]])

    todo = [np.arange(len(points))]
    while todo:
        own = todo.pop()
        if len(own) > DIRECT:
            distances = np.bitwise_count(points[own] ^ points[own[len(own) // 2]]).astype(np.int64)
            radius = split_radius(distances, max_bits)
            if radius is not None:
                todo += [own[distances <= radius], own[distances > radius - max_bits]]
                continue
        direct(own)
    return np.fromiter((top(i) for i in range(len(points))), dtype=np.int64, count=len(points))


def links(prints: DataFrame, max_bits: int = 2) -> DataFrame:
    """Links between different fingerprints: ``prints(fp)`` (distinct) to ``(a, b)``, a chain of
    links for each group of a shard, so that what is reachable stays reachable. Rows grow with
    the fingerprints that have a partner, not with pairs."""
    spark = prints.sparkSession
    n = prints.count()
    drawn = prints.orderBy(F.xxhash64("fp"), "fp").limit(TREE_SAMPLE)
    sample = np.array([r[0] for r in drawn.collect()], dtype=np.int64).view(np.uint64)
    nodes = build_tree(sample, n / max(1, len(sample)), max_bits)
    tree = spark.sparkContext.broadcast(nodes)  # at most TREE_SAMPLE nodes

    def deal(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            points = part["fp"].to_numpy(dtype=np.int64).view(np.uint64)
            own, shard = route(points, tree.value, max_bits)
            yield pd.DataFrame({"shard": shard, "fp": points[own].view(np.int64)})

    def within(part: pd.DataFrame) -> pd.DataFrame:
        points = part["fp"].to_numpy(dtype=np.int64).view(np.uint64)
        first = shard_links(points, max_bits)
        own = np.flatnonzero(first != np.arange(len(points)))
        return pd.DataFrame({"a": points[own].view(np.int64), "b": points[first[own]].view(np.int64)})

    dealt = prints.select("fp").mapInPandas(deal, "shard long, fp long")
    return dealt.groupBy("shard").applyInPandas(within, "a long, b long")


# ---- components ---------------------------------------------------------------------------


def components(edges: DataFrame) -> DataFrame:
    """``edges(a, b)`` to ``(node, label)``, label the smallest node reachable, for every node that
    has an edge. Large-star and small-star rounds; each round is written to the shared folder."""

    def star(pairs: DataFrame, large: bool) -> DataFrame:
        """pairs(u, v): v is a neighbour of u. Every wanted v is tied to u's least neighbour."""
        least = stored(pairs.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least")
        tied = pairs.join(least, "u")
        tied = tied.where("v > u") if large else tied
        return tied.select(F.col("v").alias("a"), F.col("m").alias("b"))

    def both(e: DataFrame) -> DataFrame:
        return e.select(F.col("a").alias("u"), F.col("b").alias("v")).union(e.select(F.col("b").alias("u"), F.col("a").alias("v")))

    def settled(e: DataFrame) -> tuple[int, int]:
        r = e.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
        return r["n"], r["s"]

    edges = stored(edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    state = settled(edges)
    while state[0]:
        edges = stored(star(both(edges), True).where("a != b").distinct(), "edges")
        down = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        least = stored(down.groupBy("u").agg(F.min("v").alias("m")), "least")
        tied = down.join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).union(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
        edges = stored(tied.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
        now = settled(edges)
        if now == state:
            break
        state = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("label")).union(edges.select("b", "b").distinct())


def grouped(rows: DataFrame, max_bits: int = 2) -> DataFrame:
    """``rows(doc_id, fp)`` to ``(fp, label, component_id)``, one row per distinct fingerprint."""
    prints = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("least_id")), "prints")
    linked = stored(components(links(prints.select("fp"), max_bits)).withColumnRenamed("node", "fp"), "linked")
    named = linked.join(prints, "fp").groupBy("label").agg(F.min("least_id").alias("component_id"))
    far = linked.join(named, "label").select("fp", "label", "component_id")
    return prints.join(far, "fp", "left").select(
        "fp", F.coalesce("label", "fp").alias("label"), F.when(F.col("label").isNull(), F.col("least_id")).otherwise(F.col("component_id")).alias("component_id")
    )


def simhash_components(docs: DataFrame, shingle: int = 3, max_bits: int = 2) -> DataFrame:
    """``docs(doc_id, text, ..)`` to ``(doc_id, fingerprint, component_id)``, a row for each row."""
    prepare(docs.sparkSession)
    rows = stored(docs.select("doc_id", fingerprint_column(F.col("text"), shingle).alias("fp")), "fingerprints")
    return rows.join(grouped(rows, max_bits).select("fp", "component_id"), "fp").select("doc_id", hex16(F.col("fp")).alias("fingerprint"), "component_id")


def near_dedup(docs: DataFrame, shingle: int = 3, max_bits: int = 2) -> DataFrame:
    """``docs`` with one row of each component: the one with its smallest id (null ids last), one
    of them if that row repeats. Columns stay as they are."""
    prepare(docs.sparkSession)
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    rows = stored(docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), key.alias("key"), F.col("doc_id").alias("id"), fingerprint_column(F.col("text"), shingle).alias("fp")), "rows")
    groups = stored(grouped(rows.select(F.col("id").alias("doc_id"), "fp"), max_bits), "groups")
    # several fingerprints of a component may carry its smallest id (repeated ids): take the least
    named = rows.select("fp", "id", "key").join(groups, "fp").where(F.col("id").eqNullSafe(F.col("component_id")))
    chosen = named.groupBy("label").agg(F.min(F.struct("fp", "key")).alias("one")).select("one.fp", "one.key")
    from pyspark.sql import Window

    once = F.row_number().over(Window.partitionBy("fp", "key").orderBy("fp"))
    return rows.join(chosen, ["fp", "key"]).withColumn("nth", once).where("nth = 1").select("row.*")
