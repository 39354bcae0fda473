"""Periodic runs, the conversation trie and packing against plain versions."""

import hashlib
import random
import struct
import zlib
from bisect import bisect_left, insort
from collections import Counter, defaultdict

import pytest

from .conftest import CLASHING, same


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


# ---- 11: periodic runs --------------------------------------------------------------------


def plain_runs(words, least=6, times=4):
    """All (start, length, period), from equal words at every distance."""
    places = defaultdict(list)
    for i, w in enumerate(words):
        places[w].append(i)
    equal = defaultdict(set)
    for own in places.values():
        for k, i in enumerate(own):
            for j in own[k + 1 :]:
                if times * (j - i) > len(words):
                    break
                equal[j - i].add(i)
    found = []
    for q in sorted(equal):
        for i in sorted(equal[q]):
            if i - 1 in equal[q]:
                continue
            j = i
            while j in equal[q]:
                j += 1
            end = j + q
            if end - i >= max(least, times * q) and not any(p < q and s <= i and s + n >= end for s, n, p in found):
                found.append((i, end - i, q))
    return sorted(found, key=lambda r: (r[0], r[2]))


def planted(doc_id, words):
    n = len(words)
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is None or h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def collapsed(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def test_runs_of_the_query(spark, documents, rows, empty):
    from corpusflow.llm.periodic_runs import periodic_runs, run_summary, with_planted_runs

    def want(doc_id, text):
        words = planted(doc_id, [w.decode() for w in (text or "").encode().split()])
        runs = plain_runs(words)
        best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=None)
        tail = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
        return (doc_id, len(runs), *tail, sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(collapsed(words, runs)))

    got = run_summary(periodic_runs(with_planted_runs(documents)))
    assert [t for _, t in got.dtypes] == ["bigint"] * 6 + ["string"] * 2
    same(got.collect(), [want(r[0], r[1]) for r in rows])
    assert run_summary(periodic_runs(with_planted_runs(empty))).count() == 0


def test_runs_of_small_alphabets(spark):
    """Nested, touching and overlapping runs, several at one start."""
    from corpusflow.llm.periodic_runs import periodic_runs

    rng = random.Random(3)
    texts = ["a " * 6, "a " * 5, "a b " * 4, "a b " * 3 + "a", "a a b " * 5 + "a a a a a a a", ("a " * 7 + "b ") * 6]
    for _ in range(400):
        words = [rng.choice("abcde"[: rng.choice([1, 2, 3, 5])]) for _ in range(rng.randrange(70))]
        if len(words) > 8:
            p, a = rng.randint(1, len(words) // 4), rng.randrange(len(words))
            for i in range(a, min(len(words), a + p * rng.randint(3, 9))):
                words[i] = words[a + (i - a) % p]
        texts.append(" \n".join(words))
    got = periodic_runs(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert len(got) == len(texts)
    for r in got:
        words = texts[r["doc_id"]].split()
        runs = plain_runs(words)
        assert [tuple(x) for x in r["runs"]] == runs
        assert r["collapsed"] == collapsed(words, runs) and r["n_words"] == len(words)


# ---- 12: conversation trie ----------------------------------------------------------------


def plain_trie(members):
    """Rows of the node table; ``members``: turns by conversation."""
    nodes = defaultdict(list)
    for c, turns in members.items():
        for d in range(len(turns) + 1):
            nodes[tuple(turns[:d])].append(c)
    kids = defaultdict(list)
    for node in nodes:
        if node:
            kids[node[:-1]].append(node)
    total = {}
    for node in sorted(nodes, key=len, reverse=True):
        own = (len(nodes[node]) - 1) * len(node[-1][1].encode()) if node else 0
        total[node] = (sum(total[k][0] for k in kids[node]) or 1, own + sum(total[k][1] for k in kids[node]))
    out = []
    for node, own in nodes.items():
        ends = sorted(c for c in own if len(members[c]) == len(node))
        out.append((min(own), len(node), min(nodes[node[:-1]]) if node else None, len(own), len(kids[node]), *total[node], sha(",".join(map(str, ends)))))
    return out


def conversation_rows():
    rows = [(None, 0, "user", "lost"), (1, None, None, None), (1, 0, "user", "hi"), (1, 0, "user", "hi"), (2, 0, "user", ""), (2, 1, None, "x" * 100_000), (-7, 3, "b", "Ä€"), (3, None, "", ""), (4, 0, "user", "hi")]
    rows += [(100 + c, t, "user", f"same {t}") for c in range(120) for t in range(3)]
    rows += [(300 + c, t, "bot", f"deep {min(t, c * 40)}") for c in range(8) for t in range(300)]
    return rows


@pytest.fixture(scope="module")
def conversations(spark):
    given = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet").select("conv_id", "turn", "role", "text").selectExpr("conv_id + 1000 as conv_id", "turn", "role", "text")
    both = given.union(spark.createDataFrame(conversation_rows(), "conv_id long, turn long, role string, text string"))
    extra = {**CLASHING, "node": "'n'", "depth": "1", "shard": "2", "digest": "'d'", "h": "3"}
    return both.selectExpr("*", *[f"{v} as {k}" for k, v in extra.items()]).cache()


def ordered(rows):
    own = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            own[c].append((t is not None, t or 0, r or "", x or ""))
    return {c: [(r, x) for _, _, r, x in sorted(v)] for c, v in own.items()}


def test_trie_in_many_shards(spark, conversations):
    """Copies and deep chains over many shards, several rounds and spilling queues."""
    from corpusflow.llm.prefix_trie import node_table, prefix_trie

    rows = conversations.select("conv_id", "turn", "role", "text").distinct()
    members = ordered(rows.collect()) | {5000: [], -1: []}
    alone = spark.createDataFrame([(5000, 1), (5000, 2), (-1, 3), (4, 4), (None, 5)], "conv_id long, role int")
    for shards, fanout, queue in ((1, 16, 1000), (40, 3, 2), (13, 16, 50)):
        got = node_table(prefix_trie(rows, alone, shards, fanout, queue)).collect()
        same(got, plain_trie(members))


def test_trie_of_the_query(spark, conversations):
    from corpusflow.llm.prefix_trie import node_table, prefix_trie, rebuilt

    own = ordered(map(tuple, conversations.select("conv_id", "turn", "role", "text").collect()))
    members = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        base = c - int(c / 5) * 5
        members[c] = own.get(c - base, [])[:h] + own[c][h:]
    table = node_table(prefix_trie(*rebuilt(conversations)))
    assert [t for _, t in table.dtypes] == ["bigint"] * 7 + ["string"]
    same(table.collect(), plain_trie(members))
    assert node_table(prefix_trie(*rebuilt(conversations.limit(0)))).count() == 0


def test_spilling_queue(tmp_path):
    from corpusflow.llm.prefix_trie import SpillingQueue

    rng = random.Random(1)
    queue = SpillingQueue(f"file://{tmp_path}/q", 7)
    held, out = [], []
    for _ in range(2000):
        if held and rng.random() < 0.45:
            out.append(queue.pop())
            assert out[-1] == held.pop(0)
        else:
            item = (rng.randrange(50), bytes([rng.randrange(3)]), rng.randrange(9), 1, 0)
            queue.push(item)
            insort(held, item)
    while queue:
        assert queue.pop() == held.pop(0)
    assert not held and list((tmp_path / "q").iterdir())
    queue.close()
    assert not list((tmp_path / "q").iterdir())


# ---- 13: packing --------------------------------------------------------------------------


def best_fit_decreasing(lengths, capacity):
    """Number of bins."""
    gaps, bins = [], 0
    for n in sorted(lengths, reverse=True):
        k = bisect_left(gaps, n)
        if k == len(gaps):
            bins += 1
            gap = capacity
        else:
            gap = gaps.pop(k)
        if gap > n:
            insort(gaps, gap - n)
    return bins


def test_packing(spark, documents, rows, empty):
    import public_tokenizers
    from tokenizers import Tokenizer

    from corpusflow.llm.packing import packed_documents, packed_sequences

    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    odd = ["don't 'll x's it's ÉTÉ İstanbul ǅ Σίσυφος ΣΑΣ ﬁ é ́x a b c\x1cd\x85e", "<|endoftext|> a<|startoftext|>b <|x", "1234 ½ ² _a_ a_b --- ... a.b a. (a) ()", "퟿\U0001f600 한국어 ไทย हिन्दी", " ", "İ İ. ŉ ŉ,"]
    extra = spark.createDataFrame([(800000 + k, t) for k, t in enumerate(odd)], "doc_id long, text string")
    docs = documents.unionByName(extra, allowMissingColumns=True)
    want = []
    texts = [(r[0], r[1]) for r in rows] + [(800000 + k, t) for k, t in enumerate(odd)]
    whole = {}
    for doc_id, text in texts:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        whole[doc_id] = ids
        for k, at in enumerate(range(0, len(ids), 4096)):
            own = ids[at : at + 4096]
            want.append((doc_id, k, at, len(own), zlib.crc32(struct.pack(f"<{len(own)}I", *own))))
    packed = packed_documents(docs)
    assert packed.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    got = packed.collect()
    same([r[:5] for r in got], want)
    gapless(got, 4096)
    assert len({r["sequence_id"] for r in got}) == best_fit_decreasing([w[3] for w in want], 4096)
    made = packed_sequences(docs.where("doc_id < 60"), capacity=512, end_id=7).collect()
    pieces = Counter()
    for doc_id, ids in whole.items():
        if doc_id is not None and doc_id < 60:
            ids = [*ids[:-1], 7]
            pieces.update(tuple(ids[at : at + 512]) for at in range(0, len(ids), 512))
    assert sum(r["n_tokens"] for r in made) == sum(len(p) * n for p, n in pieces.items()) and max(r["n_tokens"] for r in made) <= 512
    for r in made:  # a sequence is a run of pieces, each ending with the end id or filling the sequence
        ids = struct.unpack(f"<{r['n_tokens']}I", r["ids"])
        at = 0
        while at < len(ids):
            to = next((to for to in range(at + 1, len(ids) + 1) if pieces[ids[at:to]]), None)
            assert to
            pieces[ids[at:to]] -= 1
            at = to
    assert not +pieces
    assert packed_documents(empty).count() == 0


def gapless(rows, capacity):
    sequences = defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for own in sequences.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= capacity


@pytest.mark.parametrize("capacity, kind", [(100, "even"), (100, "small"), (64, "hot"), (7, "even"), (4096, "wide")])
def test_best_fit(spark, capacity, kind):
    from corpusflow.llm.packing import best_fit, plan

    rng = random.Random(capacity)
    draw = {"even": lambda: rng.randint(1, capacity), "small": lambda: rng.choice([1, 1, 2, 3, 51]), "hot": lambda: rng.choice([17, 17, 17, rng.randint(1, 64)]), "wide": lambda: min(capacity, int(2 ** rng.uniform(0, 12.2)))}[kind]
    lengths = [draw() for _ in range(5000)]
    items = spark.createDataFrame([(i, n, "x") for i, n in enumerate(lengths)], "id long, length long, _part string")
    got = best_fit(items.drop("_part").repartition(7), capacity).collect()
    same([(r["id"], r["length"]) for r in got], list(enumerate(lengths)))
    gapless(got, capacity)
    assert len({r["sequence_id"] for r in got}) == best_fit_decreasing(lengths, capacity) == plan(Counter(lengths), capacity)[1]
