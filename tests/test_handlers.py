"""Handler lists of any length, resolver modules by name."""

import random

from pyspark.sql import functions as F

from corpusflow.operators import resolve as RS


def test_automaton_equals_case(spark):
    rng = random.Random(4)
    word = lambda n: "".join(rng.choice("abc.") for _ in range(n))
    urls = spark.createDataFrame([(f"https://{word(rng.randint(1, 25))}/p",) for _ in range(300)] + [(None,), ("nothing",), ("https:///x",)], "url string")
    for handlers in ([(word(rng.randint(1, 5)), f"m{i}") for i in range(60)], [("zz", "a"), ("", "b"), ("a", "c")], [("zz", "a")], [("", "x")]):
        both = urls.select(RS.match_handler("url", handlers).alias("a"), RS.match_handler_many(spark, "url", handlers).alias("b"))
        assert both.where(~F.col("a").eqNullSafe(F.col("b"))).count() == 0


def test_a_hundred_thousand_patterns(spark):
    """The plan doesn't grow with the list, and the first pattern in order wins."""
    handlers = [(f"h{i}.", f"m{i}") for i in range(100_000)]
    urls = spark.range(3000).select(F.concat(F.lit("https://x.h"), ((F.col("id") * 7919) % 200_000).cast("string"), F.lit(".org/")).alias("url"), ((F.col("id") * 7919) % 200_000).alias("k"))
    got = RS.HandlerRegistry().dispatch(urls, "url", handlers)
    plan = got._jdf.queryExecution().toString()
    assert len(plan) < 20_000
    want = F.when(F.col("k") < 100_000, F.concat(F.lit("m"), F.col("k").cast("string")))
    assert got.where(~F.col("handler").eqNullSafe(want)).count() == 0


def test_modules_by_name(spark):
    base = "corpusflow.plans.handlers."
    rows = [("http://a.b/c", None), ("http://a.b/cd", base + "secure"), ("http://a.b/c", base + "secure"), ("http://a.b/cd", base + "raising"), (None, base + "raising"), ("u", base + "silent"), ("u", "no.such.module"), ("u", "")]
    got = RS.resolve_by_module(spark.createDataFrame(rows, "url string, handler string"), "url").collect()
    assert len(got) == len(rows)
    answers = {(r["url"], r["handler"]): (r["resolved_url"], r["resolve_error"]) for r in got}
    assert answers[("http://a.b/c", None)] == ("http://a.b/c", None)
    assert answers[("http://a.b/cd", base + "secure")] == ("https://a.b/cd#secure", None)
    assert answers[("http://a.b/c", base + "secure")] == ("http://a.b/c", None)
    assert answers[("http://a.b/cd", base + "raising")] == ("http://a.b/cd", "resolver failed: ValueError")
    assert answers[(None, base + "raising")] == (None, "resolver failed: TypeError")
    assert answers[("u", base + "silent")] == ("u", "module has no resolve_pdf_url")
    assert answers[("u", "no.such.module")] == ("u", "module can't be loaded: ModuleNotFoundError")
    assert answers[("u", "")][1].startswith("module can't be loaded")


def test_long_lists_as_arrays(spark):
    """A handler takes tens of bytes beside its texts; patterns repeat, overlap, aren't ASCII, or are empty."""
    table = RS._pattern_table([(f"h{i}.", f"m{i}") for i in range(50_000)])
    kept = sum(getattr(v, "nbytes", 0) for v in table.values())
    assert kept < 50_000 * 80
    rng = random.Random(6)
    word = lambda n: "".join(rng.choice("ab.é\U0001f600") for _ in range(n))
    texts = [word(rng.randint(0, 30)) for _ in range(400)] + [None, "", "ab" * 300_000 + "é"]
    for handlers in ([(word(rng.randint(1, 6)), str(i)) for i in range(300)], [("q", "0"), ("q", "1"), ("bé", "2")], [("b", "0"), ("", "1"), ("a", "2")], []):
        got = RS._first_patterns(texts, RS._pattern_table(handlers))
        assert got == [None if t is None else min((i for i, (p, _) in enumerate(handlers) if p in t), default=None) for t in texts]
