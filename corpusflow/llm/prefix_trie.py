"""The trie of conversation prefixes, its subtree totals by time-forward processing.

A node is a distinct sequence of a conversation's first turns (role and text), named by a chained
128-bit digest; the root is the empty sequence. Conversations are dealt to shards by ranges of (first
digests, whole sequence's digest, id), so subtrees mostly stay together and copies of one
conversation spread over as many shards as they fill. A node is settled in the smallest group of
neighbouring shards that holds all its members: one shard, ``FANOUT`` of them, ``FANOUT`` squared, and so
on up to all, so a parent's group never lies within its child's.

Totals go up in rounds, single shards first. Within a group nodes are externally sorted by reverse level order
(Spark's sort, which spills) and read as a stream: a node takes what its children sent from a priority queue, adds
its own and sends the sum to its parent's place in the order. A queue over ``QUEUE_ROWS`` entries
writes them as a sorted run to the shared folder and merges its runs when it is read. What a group's roots
send to parents of larger groups is summed by parent and joined to these nodes in their round. Besides one
conversation's digests no task holds anything that grows with the input.

Defined results: a null role or text is empty; turns go by number, null first, then by their
digests; a repeated row is one more turn; rows without ``conv_id`` belong to no conversation; ids in
``conversations`` without turns are members of the root; an empty table gives no node.
"""

from __future__ import annotations

import hashlib
import heapq
import pickle
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import prepare, shared_path, stored
from .token_files import file_system

ROOT = bytes(16)
#: Digests in the key of the shards' ranges (bounds are sampled to the driver, so the key stays small).
KEY_DEPTH = 8
#: Neighbouring groups that make a group of the next round.
FANOUT = 16
#: Entries of a priority queue in memory.
QUEUE_ROWS = 500_000
#: Ids of one node that are written as one string.
IDS_IN_CHUNK = 4_096

PATHS = "conv_id long, nodes array<binary>, sizes array<long>"
SENT = "node binary, parent binary, depth long, conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, message boolean"


@dataclass(frozen=True)
class Trie:
    """``nodes(node, parent, depth, conv_id, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens)``
    and ``ends(node, conv_id, shard)``: the conversations that end in a node, ids ascending with shards."""

    nodes: DataFrame
    ends: DataFrame


class SpillingQueue:
    """A priority queue of tuples; beyond ``limit`` entries they go to sorted runs below ``folder``."""

    def __init__(self, folder: str, limit: int = QUEUE_ROWS):
        self.folder, self.limit = folder, limit
        self.heap: list[tuple] = []
        self.runs: list[tuple[tuple, int, Iterator[tuple]]] = []  # (head, number, rest), a heap
        self.files: list = []

    def __bool__(self) -> bool:
        return bool(self.heap or self.runs)

    def push(self, item: tuple) -> None:
        if len(self.heap) >= self.limit:
            self._spill()
        heapq.heappush(self.heap, item)

    def first(self) -> tuple:
        if self.runs and (not self.heap or self.runs[0][0] < self.heap[0]):
            return self.runs[0][0]
        return self.heap[0]

    def pop(self) -> tuple:
        if self.runs and (not self.heap or self.runs[0][0] < self.heap[0]):
            head, number, rest = self.runs[0]
            after = next(rest, None)
            if after is None:
                heapq.heappop(self.runs)
            else:
                heapq.heapreplace(self.runs, (after, number, rest))
            return head
        return heapq.heappop(self.heap)

    def _spill(self) -> None:
        fs, base = file_system(self.folder)
        fs.create_dir(base, recursive=True)
        path = f"{base}/run-{uuid.uuid4().hex}"
        self.heap.sort()
        with fs.open_output_stream(path) as sink:
            for at in range(0, len(self.heap), 4096):
                pickle.dump(self.heap[at : at + 4096], sink)
        self.files.append((fs, path))
        rest = self._read(fs, path)
        heapq.heappush(self.runs, (next(rest), len(self.files), rest))
        self.heap = []

    @staticmethod
    def _read(fs, path: str) -> Iterator[tuple]:
        with fs.open_input_stream(path) as source:
            while True:
                try:
                    part = pickle.load(source)
                except EOFError:
                    return
                yield from part

    def close(self) -> None:
        self.heap, self.runs = [], []
        for fs, path in self.files:
            fs.delete_file(path)
        self.files = []


def time_forward(nodes: Iterator[tuple], queue: SpillingQueue) -> Iterator[tuple]:
    """``nodes`` are (node, parent, depth, conv_id, n_convs, children, leaves, saved) of one group in reverse level
    order, the last three being what other groups sent and the node's own saving. Yields each
    with its totals and False, and for parents outside the group sums with True."""

    def outside(key: tuple) -> tuple:
        children = leaves = saved = 0
        while queue and queue.first()[:2] == key:
            _, _, c, n, s = queue.pop()
            children, leaves, saved = children + c, leaves + n, saved + s
        return (key[1], None, -key[0], None, None, children, leaves, saved, True)

    for node, parent, depth, conv, n_convs, children, leaves, saved in nodes:
        key = (-depth, node)
        while queue and (head := queue.first())[:2] <= key:
            if head[:2] < key:
                yield outside(head[:2])
                continue
            _, _, c, n, s = queue.pop()
            children, leaves, saved = children + c, leaves + n, saved + s
        leaves = leaves or 1
        yield (node, parent, depth, conv, n_convs, children, leaves, saved, False)
        if parent is not None:
            queue.push((1 - depth, parent, 1, leaves, saved))
    while queue:
        yield outside(queue.first()[:2])


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*[c.to_pylist() for c in batch.columns])


def _batches(rows: Iterator[tuple], schema: pa.Schema, size: int = 2_000) -> Iterator[pa.RecordBatch]:
    part: list[tuple] = []
    for row in rows:
        part.append(row)
        if len(part) == size:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*part), schema)], schema=schema)
            part = []
    if part:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*part), schema)], schema=schema)


def _shuffle_tasks(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def paths(turns: DataFrame, conversations: DataFrame | None = None) -> DataFrame:
    """``(conv_id, nodes, sizes)`` a conversation: the digests of its prefixes from the root on, and the
    bytes of each one's last text. Only digests are shuffled, not texts."""
    role, text = F.coalesce(F.col("role").cast("string"), F.lit("")), F.coalesce(F.col("text").cast("string"), F.lit(""))
    turn = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    rows = turns.where("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), "turn", F.unhex(F.sha2(turn.cast("binary"), 256)).alias("digest"), F.octet_length(text).cast("long").alias("size"))
    if conversations is not None:
        alone = conversations.where("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"))
        rows = rows.unionByName(alone, allowMissingColumns=True)
    dealt = rows.repartition(_shuffle_tasks(turns), "conv_id").sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "digest").select("conv_id", "digest", "size")
    schema = pa.schema([("conv_id", pa.int64()), ("nodes", pa.list_(pa.binary())), ("sizes", pa.list_(pa.int64()))])

    def chained(rows: Iterator[tuple]) -> Iterator[tuple]:
        conv, nodes, sizes = None, [], []
        for own, digest, size in rows:
            if own != conv:
                if conv is not None:
                    yield conv, nodes, sizes
                conv, nodes, sizes = own, [ROOT], [0]
            if digest is not None:
                nodes.append(hashlib.blake2b(nodes[-1] + digest, digest_size=16).digest())
                sizes.append(size)
        if conv is not None:
            yield conv, nodes, sizes

    return dealt.mapInArrow(lambda batches: _batches(chained(_rows(batches)), schema, 200), PATHS)


def prefix_trie(turns: DataFrame, conversations: DataFrame | None = None, shards: int | None = None, fanout: int = FANOUT, queue_rows: int = QUEUE_ROWS) -> Trie:
    """The trie of ``turns(conv_id, turn, role, text, ..)``; ``conversations(conv_id, ..)`` may name ids
    that have no turn."""
    spark = prepare(turns.sparkSession)
    count = shards or _shuffle_tasks(turns)
    key = [F.slice("nodes", 2, KEY_DEPTH), F.element_at("nodes", -1), F.col("conv_id")]
    # the range bounds are sampled: written once, so that every reader sees the same shards
    dealt = stored(paths(turns, conversations).repartitionByRange(count, *key).withColumn("shard", F.spark_partition_id()), "trie-paths")

    steps = F.transform("nodes", lambda x, i: F.struct(x.alias("node"), F.when(i > 0, F.get("nodes", i - 1)).alias("parent"), i.cast("long").alias("depth"), F.get("sizes", i).alias("size")))
    seen = dealt.select("conv_id", "shard", F.inline(steps))
    members = seen.groupBy("node", "parent", "depth", "size").agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.min("shard").alias("low"), F.max("shard").alias("high"))
    rounds, width = 1, 1
    while width < count:
        rounds, width = rounds + 1, width * fanout
    level = F.coalesce(*[F.when(F.floor(F.col("low") / fanout**k) == F.floor(F.col("high") / fanout**k), F.lit(k)) for k in range(rounds)])
    saving = (F.col("n_convs") - 1) * F.col("size")
    nodes = stored(members.withColumn("level", level).selectExpr("*", f"cast(floor(low / power({fanout}, level)) as int) as home").withColumn("saving", saving).drop("low", "high", "size"), "trie-nodes")

    queues = shared_path(spark, "trie-queues")
    schema = pa.schema([("node", pa.binary()), ("parent", pa.binary()), *[(c, pa.int64()) for c in ("depth", "conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")], ("message", pa.bool_())])

    def passed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queue = SpillingQueue(queues, queue_rows)

        def groups(rows: Iterator[tuple]) -> Iterator[tuple]:
            row = next(rows, None)
            while row is not None:
                home = row[0]

                def own() -> Iterator[tuple]:
                    nonlocal row
                    while row is not None and row[0] == home:
                        yield row[1:]
                        row = next(rows, None)

                yield from time_forward(own(), queue)

        try:
            yield from _batches(groups(_rows(batches)), schema)
        finally:
            queue.close()

    done: list[DataFrame] = []
    for k in range(rounds):
        here = nodes.where(F.col("level") == k)
        got = [F.lit(0).cast("long").alias(c) for c in ("children", "leaves", "saved")]
        if done:
            sent = done[0]
            for d in done[1:]:
                sent = sent.unionByName(d)
            sums = [F.sum(a).alias(b) for a, b in (("n_children", "children"), ("n_leaves", "leaves"), ("saved_tokens", "saved"))]
            here = here.join(sent.where("message").groupBy(F.col("node").alias("target")).agg(*sums), F.col("node") == F.col("target"), "left")
            got = [F.coalesce(F.col(c), F.lit(0).cast("long")).alias(c) for c in ("children", "leaves", "saved")]
        rows = here.select("home", "node", "parent", "depth", "conv_id", "n_convs", *got[:2], (got[2] + F.col("saving")).alias("saved"))
        tasks = max(1, -(-count // fanout**k))
        ordered = rows.repartition(tasks, "home").sortWithinPartitions("home", F.col("depth").desc(), "node")
        done.append(stored(ordered.mapInArrow(passed, SENT), f"trie-round{k}"))

    result = done[0]
    for d in done[1:]:
        result = result.unionByName(d)
    result = result.where("not message").drop("message")
    # the root's children may be a third of all nodes: a join that Spark can split at its larger side
    parents = nodes.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    result = result.join(parents, "parent", "left").select("node", "parent", "depth", "conv_id", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")
    return Trie(result, dealt.select(F.element_at("nodes", -1).alias("node"), "conv_id", "shard"))


def ends_digests(ends: DataFrame) -> DataFrame:
    """``(node, ends_sha256)``: SHA-256 of each node's ids, ascending, joined by commas. Ids become strings of
    up to ``IDS_IN_CHUNK`` of them in their shards; only these strings of a node meet, as a stream."""
    tasks = _shuffle_tasks(ends)

    def chunks(rows: Iterator[tuple]) -> Iterator[tuple]:
        last, part, n = None, [], 0
        for node, shard, conv in rows:
            if (node, shard) != last or len(part) == IDS_IN_CHUNK:
                if part:
                    yield *last, n, ",".join(part)
                n = n + 1 if (node, shard) == last else 0
                last, part = (node, shard), []
            part.append(str(conv))
        if part:
            yield *last, n, ",".join(part)

    def digests(rows: Iterator[tuple]) -> Iterator[tuple]:
        last, state = None, None
        for node, ids in rows:
            if node != last:
                if state is not None:
                    yield last, state.hexdigest()
                last, state = node, hashlib.sha256(ids.encode())
            else:
                state.update(b"," + ids.encode())
        if state is not None:
            yield last, state.hexdigest()

    chunk = pa.schema([("node", pa.binary()), ("shard", pa.int32()), ("n", pa.int64()), ("ids", pa.string())])
    digest = pa.schema([("node", pa.binary()), ("ends_sha256", pa.string())])
    sorted_ends = ends.select("node", "shard", "conv_id").repartition(tasks, "shard", "node").sortWithinPartitions("node", "shard", "conv_id")
    written = sorted_ends.mapInArrow(lambda b: _batches(chunks(_rows(b)), chunk, 100), "node binary, shard int, n long, ids string")
    ordered = written.repartition(tasks, "node").sortWithinPartitions("node", "shard", "n").select("node", "ids")
    return ordered.mapInArrow(lambda b: _batches(digests(_rows(b)), digest), "node binary, ends_sha256 string")


def node_table(trie: Trie) -> DataFrame:
    """The nodes with the digests of the conversations that end in them."""
    none = hashlib.sha256().hexdigest()
    return trie.nodes.join(ends_digests(trie.ends), "node", "left").select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(none)).alias("ends_sha256"))


# ---- what the query adds ------------------------------------------------------------------


def rebuilt(turns: DataFrame, family: int = 5, most: int = 8) -> tuple[DataFrame, DataFrame]:
    """(turns, conversations) where conversation c begins with the first h turns of conversation
    c - c % ``family`` and goes on with its own after its first h; h is CRC-32 of c modulo ``most`` + 1."""
    from pyspark.sql import Window

    own = turns.where("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    numbered = own.withColumn("turn", F.row_number().over(order).cast("long")).withColumn("h", F.crc32(F.col("conv_id").cast("string").cast("binary")) % (most + 1))
    conversations = numbered.groupBy("conv_id", "h").agg(F.lit(None).cast("long").alias("none")).drop("none")
    heads = numbered.where((F.col("turn") <= most) & (F.col("conv_id") % family == 0)).select(F.col("conv_id").alias("base"), "turn", "role", "text")
    borrowed = conversations.withColumn("base", F.col("conv_id") - F.col("conv_id") % family).join(heads, "base").where("turn <= h")
    columns = ["conv_id", "turn", "role", "text"]
    after = numbered.where("turn > h").withColumn("turn", F.col("turn") + most)
    return borrowed.select(columns).unionByName(after.select(columns)), conversations.select("conv_id")
