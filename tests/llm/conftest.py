"""Rows that every operator must survive, beside the smallest given tables."""

import os

import pytest

SF = "/root/testdata/sf0.001"
CLASHING = {"row": "1", "fp": "2L", "words": "'w'", "size": "3", "key": "'k'", "score": "0.5D", "label": "'x'", "h": "4L", "u": "0.1D", "found": "'f'"}
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def edge_rows():
    """Nulls in any column, empty and very long texts, ties and repeated rows."""
    insult = "you idiot moron scum loser. "
    long_text = " ".join(f"w{i * 7919 % 30011}" for i in range(30_000))
    bench = "Copyright 2020 all rights reserved. Licensed under the MIT License and MIT license. Été mit  License, the GNU General Public License version 3"
    return [
        (900001, None, "en", "src1", None),
        (900002, "", "en", "src1", 0),
        (900003, " \t\n\x0b\f\r ", None, "src2", 7),
        (900004, long_text, "en", "src0", len(long_text)),
        (900005, "no" * 60_000, "en", None, 120_000),
        (900006, bench, "en", "src1", len(bench)),
        (900006, bench, "en", "src1", len(bench)),
        (900007, insult * 20, "en", "src3", 0),
        (None, "same words here for all of them", "en", "src1", 1),
        (None, "same words here for all of them", "en", "src1", 1),
        (None, None, None, None, None),
        (900008, "one two three four five six seven eight. " * 40, "de", "src9", 1),
        (900009, "Mail a.b@c.de_x@y.org or +1 (415) 555-0100, 10.0.0.256 10.0.0.255, 4111 1111 1111 1111 4111111111111111 x 4111111111111111\n\na\nb\na\n \n \n", "en", "src9", 1),
        (900010, "café \U0001f600 中文   x y  two  spaces\n\n \n<|endoftext|> 'll don't\x00z", "fr", "", 1),
        (900011, "1.2.3.4.5.6.7.8 " + "1" * 5000 + " " + "+" * 300 + "1-2-3", "fr", "", 1),
    ]


@pytest.fixture(scope="session")
def documents(spark):
    """The smallest documents and the edge rows, with extra columns of clashing names."""
    if not os.path.isdir(SF):
        pytest.skip("given tables not available")
    base = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")
    both = base.union(spark.createDataFrame(edge_rows(), SCHEMA))
    return both.selectExpr("*", *[f"{v} as {k}" for k, v in CLASHING.items()]).cache()


@pytest.fixture(scope="session")
def rows(documents):
    return [tuple(r) for r in documents.select("doc_id", "text", "lang", "source").collect()]


@pytest.fixture(scope="session")
def empty(documents):
    return documents.limit(0)


@pytest.fixture(scope="session")
def benchmark(spark):
    extra = [(None, "the GNU General Public License version 3"), (7001, None), (7002, ""), (7003, "rights reserved"), (7003, "rights reserved"), (7004, "w7919 w15838")]
    return spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").union(spark.createDataFrame(extra, "item_id long, text string")).cache()


def same(got, want):
    """Equal as multisets."""
    key = lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r)
    got, want = sorted(map(tuple, got), key=key), sorted(map(tuple, want), key=key)
    assert len(got) == len(want)
    wrong = [(g, w) for g, w in zip(got, want) if g != w]
    assert not wrong, wrong[:3]
