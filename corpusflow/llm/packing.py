"""Best-fit packing of documents into sequences of a fixed number of tokens, in synchronous steps.

Documents become token ids and an end id; those longer than a sequence are cut into whole
sequences and a rest. All pieces are range-sorted by length (longest first) and ranked within their
length: Spark sorts and counts, a piece's rank is its place in its range partition plus the counts
before it. A step settles all pieces of one length at once, in the order of lengths: bins are kept range-sorted by gap,
the sweep starts at the smallest gap that holds the length (its successor) and goes up; where several
pieces want one bin the rank decides, first ranks first, and a bin takes them as long as it stays the best fit. Gaps are updated, then
the next length follows; pieces that find no gap open bins. This is best-fit decreasing exactly: bins of one gap are alike and so are pieces
of one length, so a step is known from counts and says which interval of ranks goes to which interval of bins.
These counts and intervals (:func:`plan`) depend on the capacity, not on the number of documents: there are at most ``capacity`` lengths, two
new intervals a length, and an interval takes at most sqrt(2 * ``capacity``) different lengths. They are sent to
all tasks, which sweep their sorted pieces along them.

Ids are the tokenizer's: its pre-tokenizer never joins characters across white space, so the
parts between ASCII blanks encode on their own and are remembered.

Defined results: a null or empty text is the end id alone; repeated rows are repeated documents; a
null ``doc_id`` stays null; an empty table gives an empty result. Other columns are ignored. Reruns give
equal pieces and as many sequences; which of equally long pieces share a sequence may differ.
"""

from __future__ import annotations

import re
import struct
from array import array
from bisect import bisect_left, insort
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import new_key, once, prepare, stored
from .token_files import tokenizer_json

CAPACITY, END_ID = 4096, 1
#: Parts whose ids a worker remembers, twice: a full memory becomes the older one.
REMEMBERED = 700_000
#: Marks that the pre-tokenizer cuts off a letter, as a run of their own.
MARKS = ".,!?;:%$#*&|<>()"
PIECES = "doc_id long, piece int, start long, ids binary"


class PartEncoder:
    """A text's ids as bytes, from its parts between ASCII blanks."""

    def __init__(self, tokenizer_json: str, word_end: str = "</w>"):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        self.ends = np.zeros(self.tokenizer.get_vocab_size(), bool)
        for piece, i in self.tokenizer.get_vocab(with_added_tokens=False).items():
            self.ends[i] = piece.endswith(word_end)
        # letters of the older alphabets that normalizing turns into letters (one doesn't: U+0130)
        plain = "".join(c for c in map(chr, range(0x590)) if c.isalpha() and self.tokenizer.normalizer.normalize_str(c).isalpha())
        self.word = re.compile(f"[{plain}]+").fullmatch
        self.known: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}

    def _ids(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids).tobytes()

    def _letters(self, words: list[str]) -> None:
        """Learn words of letters: each is one pre-token, whose last id alone ends a word, so they go as one text."""
        ids = np.array(self.tokenizer.encode_batch_fast([" ".join(words)], add_special_tokens=False)[0].ids, np.uint32)
        cuts = np.flatnonzero(self.ends[ids]) + 1
        if len(cuts) == len(words) and cuts[-1] == len(ids):
            data = ids.tobytes()
            at = 0
            for word, to in zip(words, (cuts * 4).tolist()):
                self.known[word.encode()] = data[at:to]
                at = to
        else:
            self.known.update((w.encode(), self._ids(w)) for w in words)

    def _learn(self, new: set[bytes]) -> None:
        known, older, word = self.known, self.older, self.word
        unknown = new.difference(older)
        for part in new.difference(unknown):
            known[part] = older[part]
        words: set[str] = set()
        marked: list[tuple[bytes, bytes, bytes]] = []
        for part in unknown:
            text = part.decode("utf-8", "replace")
            if word(text):
                words.add(text)
                continue
            stem = text.rstrip(MARKS)
            if len(stem) < len(text) and word(stem):
                own, marks = stem.encode(), part[len(stem.encode()) :]
                marked.append((part, own, marks))
                if marks not in known:
                    known[marks] = self._ids(marks.decode())
                if own not in known:
                    if own in older:
                        known[own] = older[own]
                    else:
                        words.add(stem)
            else:
                known[part] = self._ids(text)
        if words:
            self._letters(list(words))
        for part, own, marks in marked:
            known[part] = known[own] + known[marks]

    def encode(self, texts: list[bytes | None]) -> list[bytes]:
        if len(self.known) > REMEMBERED:
            self.known, self.older = {}, self.known
        # the tokenizer lowers letters itself; only a special token's string must keep its own
        split = [(t if b"<|" in t else t.lower()).split() if t else [] for t in texts]
        self._learn(set().union(*split).difference(self.known))
        look = self.known.__getitem__
        return [b"".join(map(look, own)) for own in split]


def word_tokenizer_json(path: str | None = None) -> str:
    import public_tokenizers

    return tokenizer_json(path or public_tokenizers.path("word_bpe_49k.json"))


def token_pieces(docs: DataFrame, capacity: int = CAPACITY, end_id: int = END_ID, tokenizer_path: str | None = None) -> DataFrame:
    """``(doc_id, piece, start, ids)``: each document's ids and ``end_id``, cut into pieces of at most
    ``capacity`` (little-endian unsigned 32-bit integers)."""
    spark = prepare(docs.sparkSession)
    vocabulary = spark.sparkContext.broadcast(word_tokenizer_json(tokenizer_path))
    key, end, most = new_key(), struct.pack("<I", end_id), 4 * capacity

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            encoder = once(key, lambda: PartEncoder(vocabulary.value))
            rows: list[tuple] = []
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), encoder.encode(batch.column("text").to_pylist())):
                ids += end
                rows += [(doc_id, k, at // 4, ids[at : at + most]) for k, at in enumerate(range(0, len(ids), most))]
            ids_, piece, start, data = zip(*rows)
            yield pa.RecordBatch.from_arrays([pa.array(ids_, pa.int64()), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(data, pa.binary())], names=["doc_id", "piece", "start", "ids"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text")).mapInArrow(task, PIECES)


# ---- the packer ---------------------------------------------------------------------------


def plan(counts: Mapping[int, int], capacity: int) -> tuple[np.ndarray, int]:
    """Moves of best-fit decreasing for ``counts`` pieces by length, and the number of bins. A move (length, rank,
    bins, each, bin, offset) puts ranks ``rank + i`` (i < bins * each) into bin ``bin + i // each`` at ``offset + i % each * length``."""
    moves: list[tuple[int, int, int, int, int, int]] = []
    bins: dict[int, list[tuple[int, int]]] = {}  # gap: intervals (first bin, bins)
    gaps: list[int] = []  # sorted
    opened = 0

    def add(gap: int, first: int, n: int) -> None:
        if gap and n:
            if gap not in bins:
                bins[gap] = []
                insort(gaps, gap)
            bins[gap].append((first, n))

    for length in sorted(counts, reverse=True):
        if not 0 < length <= capacity:
            raise ValueError(f"length {length} is outside 1 to {capacity}")
        rank, left = 0, counts[length]
        while left:
            at = bisect_left(gaps, length)  # the successor
            if at == len(gaps):
                n = -(-left // (capacity // length))
                add(capacity, opened, n)
                opened += n
                continue
            gap = gaps[at]
            first, n = bins[gap].pop()
            if not bins[gap]:
                del bins[gap], gaps[at]
            each = gap // length
            used = min(n, left // each)
            if used:
                moves.append((length, rank, used, each, first, capacity - gap))
                add(gap - each * length, first, used)
                rank, left = rank + used * each, left - used * each
            if left and used < n:  # fewer than ``each`` are left, for one bin more
                moves.append((length, rank, 1, left, first + used, capacity - gap))
                add(gap - left * length, first + used, 1)
                used, left = used + 1, 0
            add(gap, first + used, n - used)
    return np.array(sorted(moves), np.int64).reshape(-1, 6), opened


def best_fit(items: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``items(length, ..)`` with ``sequence_id`` and ``offset``; lengths are 1 to ``capacity``. The
    items are written once, so that all that follows sees the same rows."""
    spark = prepare(items.sparkSession)
    rows = stored(items.withColumn("_row", F.monotonically_increasing_id()), "pack-items")
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    sort = [F.col("length").desc(), F.col("_row")]
    place = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)  # in the partition
    ranged = stored(rows.repartitionByRange(tasks, *sort).sortWithinPartitions(*sort).withColumn("_part", F.spark_partition_id()).withColumn("_at", place), "pack-ranged")
    # a row for each length and one more for each partition at most
    found = ranged.groupBy("_part", "length").agg(F.count(F.lit(1)).alias("n"), F.min("_at").alias("at")).collect()
    counts: dict[int, int] = {}
    shift = []  # (partition, length, rank minus place)
    for r in sorted(found, key=lambda r: (r["_part"], -r["length"])):
        shift.append((r["_part"], r["length"], counts.get(r["length"], 0) - r["at"]))
        counts[r["length"]] = counts.get(r["length"], 0) + r["n"]
    moves, _ = plan(counts, capacity)
    sent = spark.sparkContext.broadcast((np.array(sorted(shift), np.int64).reshape(-1, 3), moves))
    kept = [c for c in rows.columns if c != "_row"]
    names = [*kept, "sequence_id", "offset"]
    schema = rows.select(kept).withColumn("sequence_id", F.lit(0).cast("long")).withColumn("offset", F.lit(0).cast("long")).schema

    def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shift, moves = sent.value
        wide = capacity + 1
        shift_key, move_key = shift[:, 0] * wide + shift[:, 1], (moves[:, 0] << 48) + moves[:, 1]
        for batch in batches:
            if not batch.num_rows:
                continue
            length, part, at = (np.asarray(batch.column(c).to_pylist(), np.int64) for c in ("length", "_part", "_at"))
            rank = at + shift[np.searchsorted(shift_key, part * wide + length), 2]
            move = moves[np.searchsorted(move_key, (length << 48) + rank, side="right") - 1]
            i = rank - move[:, 1]
            sequence, offset = move[:, 4] + i // move[:, 3], move[:, 5] + i % move[:, 3] * length
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], pa.array(sequence), pa.array(offset)], names=names)

    return ranged.mapInArrow(sweep, schema)


def packed_documents(docs: DataFrame, capacity: int = CAPACITY, end_id: int = END_ID, tokenizer_path: str | None = None) -> DataFrame:
    """The pieces of ``docs`` with CRC-32 of their ids, ``sequence_id`` and ``offset``. Ids aren't kept."""
    pieces = token_pieces(docs, capacity, end_id, tokenizer_path)
    described = pieces.select("doc_id", "piece", "start", (F.octet_length("ids") / 4).cast("long").alias("length"), F.crc32("ids").alias("ids_crc32"))
    return best_fit(described, capacity)


def packed_sequences(docs: DataFrame, capacity: int = CAPACITY, end_id: int = END_ID, tokenizer_path: str | None = None) -> DataFrame:
    """``(sequence_id, n_tokens, ids)``: the sequences themselves, at most ``capacity`` ids each."""
    pieces = token_pieces(docs, capacity, end_id, tokenizer_path)
    packed = best_fit(pieces.withColumn("length", (F.octet_length("ids") / 4).cast("long")), capacity)
    # at most ``capacity`` pieces of ``capacity`` ids in all
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(parts, F.lit(b""), lambda out, x: F.concat(out, x["ids"]))
    return packed.groupBy("sequence_id").agg(F.sum("length").alias("n_tokens"), joined.alias("ids"))
