"""Token counts by a linear longest-match automaton.

The vocabulary's pieces form a trie with two roots, for the start of a word and for what follows.
A node that can't go on fails over to the node that the greedy longest match would have reached; the
number of pieces popped on the way is computed beforehand. So a word's greedy word-piece length
takes one step a byte and builds no piece. Words that a worker has met are remembered.

The vocabulary comes from a byte-level tokenizer file: pieces that start with its blank mark
(without it) start words, the others continue them, and any single byte may do either, so every
word has a length.

Defined results: null, empty and word-less texts have no words and no tokens; repeated rows get
equal results; an empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import new_key, once, prepare
from .token_files import tokenizer_json

#: Words a worker remembers; the memory is emptied when full.
REMEMBERED = 500_000
START, INSIDE = 0, 1  # the roots


def byte_names() -> dict[str, int]:
    """The byte-level alphabet: printable bytes stand for themselves, the others follow from 256."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    names = {chr(b): b for b in plain}
    return names | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in set(plain))}


def pieces(tokenizer: str) -> tuple[set[bytes], set[bytes]]:
    """(pieces that start a word, pieces that continue one) of a byte-level tokenizer's JSON."""
    names = byte_names()
    mark = next(c for c, b in names.items() if b == 32)
    single = {bytes([b]) for b in range(256)}
    starts, inner = set(single), set(single)
    for piece in json.loads(tokenizer)["model"]["vocab"]:
        if all(c in names for c in piece):
            if piece.startswith(mark) and len(piece) > 1:
                starts.add(bytes(names[c] for c in piece[1:]))
            else:
                inner.add(bytes(names[c] for c in piece))
    return starts, inner


class Automaton:
    """``step`` maps node * 256 + byte to a node; ``fail`` and ``popped`` are by node; -1: no way on."""

    def __init__(self, starts: set[bytes], inner: set[bytes]):
        self.step: dict[int, int] = {}
        parent, byte, ends = [-1, -1], [0, 0], [False, False]
        for root, own in ((START, starts), (INSIDE, inner)):
            for piece in sorted(own):
                at = root
                for b in piece:
                    to = self.step.get(at << 8 | b)
                    if to is None:
                        to = self.step[at << 8 | b] = len(parent)
                        parent.append(at)
                        byte.append(b)
                        ends.append(False)
                    at = to
                ends[at] = True
        n = len(parent)
        depth = [0] * n
        for v in range(2, n):  # a parent precedes its children
            depth[v] = depth[parent[v]] + 1
        self.fail, self.popped = [-1] * n, [0] * n
        for v in sorted(range(2, n), key=depth.__getitem__):
            if ends[v]:
                self.fail[v], self.popped[v] = INSIDE, 1
                continue
            u, b = parent[v], byte[v]
            count, z = self.popped[u], self.fail[u]
            while z >= 0 and z << 8 | b not in self.step:
                count += self.popped[z]
                z = self.fail[z]
            if z >= 0:
                self.fail[v], self.popped[v] = self.step[z << 8 | b], count

    def count(self, word: bytes) -> int:
        """Number of greedy longest-match pieces; -1 if the vocabulary can't write the word."""
        step, fail, popped = self.step, self.fail, self.popped
        at, n = START, 0
        for b in word:
            to = step.get(at << 8 | b)
            while to is None:
                n += popped[at]
                at = fail[at]
                if at < 0:
                    return -1
                to = step.get(at << 8 | b)
            at = to
        while at > INSIDE:
            n += popped[at]
            at = fail[at]
        return n if at >= 0 else -1


class _Known(dict):
    def __init__(self, automaton: Automaton):
        super().__init__()
        self.automaton = automaton

    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        n = self.automaton.count(word)
        if len(word) <= 64:
            self[word] = n
        return n


def token_counts(docs: DataFrame, tokenizer_path: str | None = None) -> DataFrame:
    """``(doc_id, n_words, n_tokens)`` for each row of ``docs``; words are ``[^\\x20\\x09-\\x0D]+``."""
    spark = prepare(docs.sparkSession)
    # bounded by the vocabulary
    sent = spark.sparkContext.broadcast(pieces(tokenizer_json(tokenizer_path)))
    key = new_key()

    @F.pandas_udf("struct<n_words:long,n_tokens:long>")
    def counted(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        known = once(key, lambda: _Known(Automaton(*sent.value)))
        for part in parts:
            words, tokens = [], []
            for text in part:
                own = (text or "").encode("utf-8", "surrogatepass").split()
                words.append(len(own))
                tokens.append(sum(map(known.__getitem__, own)))
            yield pd.DataFrame({"n_words": words, "n_tokens": tokens}, dtype="int64")

    return docs.select("doc_id", counted("text").alias("c")).select("doc_id", "c.n_words", "c.n_tokens")
