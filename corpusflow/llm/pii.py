"""Personal data by candidate gradient boosting.

Generators propose spans with high recall, overlapping ones included; a boosted tree ensemble scores
each by its format and its context; spans above a calibrated threshold of their kind are added to
the base spans (an e-mail, IP, card or phone pattern that passes its check), which always stay.

The ensemble is trained on one half of all candidates and calibrated on the other (by a hash of place and string);
weak rules label them. Candidates of equal features are counted first and weigh as many, so training
takes as many rows as there are different ones. Its trees become one SQL expression, so scoring stays within the row: no
shuffle and no Python, whatever the number of spans.

Defined results: a null text is empty; empty texts and texts without digits or ``@`` have no
spans; repeated rows get equal results; without candidates of both labels the method adds
nothing; an empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fixed, let, prepare, stored

KINDS = ("email", "ip", "card", "phone", "secret", "id")
#: Rows of a task that trains the ensemble.
POINTS = 50_000
#: Precision that a kind's threshold must reach on the calibration half.
PRECISION = 0.95
TREES, DEPTH = 12, 4
CONTEXT = 24

# Generators: kind, expression (possessive, so that long runs neither recurse nor backtrack),
# characters of which a text must hold one, whether it is the contract's base pattern.
GENERATORS = (
    ("email", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@", True),
    ("ip", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", ".", True),
    ("card", r"[0-9](?:[\x20-]?[0-9])++", "", True),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", "+", True),
    ("email", r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{2,64}+ ?(?:\(at\)|\[at\]|\{at\}) ?[A-Za-z0-9-]{2,64}+(?: ?(?:\.|\(dot\)|\[dot\]|\{dot\}) ?[A-Za-z0-9-]{2,64}+){1,4}+", "a", False),
    ("card", r"(?<![0-9])[0-9]{13,19}+(?![0-9])", "", False),
    ("phone", r"(?<![0-9.+])(?:\([0-9]{2,4}\)|[0-9]{2,4})[\x20.-][0-9]{3,4}[\x20.-][0-9]{3,4}(?![0-9])", "", False),
    ("secret", r"(?<![A-Za-z0-9_-])[A-Za-z0-9_-]{20,128}+(?![A-Za-z0-9_-])", "", False),
    ("id", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", "-", False),
    ("id", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}+(?![A-Za-z0-9])", "", False),
)
#: Words before a span that speak for its kind.
HINTS = ("mail|contact|write", "ip|host|server|address", "card|visa|master|payment", "phone|tel|call|fax|mobile", "token|key|secret|password|passwd|api", "ssn|social|iban|account|passport")
FEATURES = ("kind", "length", "digits", "letters", "marks", "groups", "luhn", "octets", "at", "plus", "hex", "mixed", "hint", "any_hint", "quoted", "before", "after")


def _starts(text: Column, form: str) -> Column:
    """Array of (s, m): start and string of an expression's matches, in code points."""
    found = F.regexp_extract_all(text, F.lit(form), F.lit(0))

    def places(m: Column) -> Column:
        def walk(p: Column) -> Column:
            start = F.struct(F.lit(0).alias("at"), F.expr("cast(array() as array<struct<s:int,m:string>>)").alias("out"))

            def step(acc: Column, k: Column) -> Column:
                at = acc["at"] + F.length(F.element_at(p, k + 1))
                one = F.element_at(m, k + 1)
                return F.struct((at + F.length(one)).alias("at"), F.concat(acc["out"], F.array(F.struct(at.alias("s"), one.alias("m")))).alias("out"))

            return F.aggregate(F.sequence(F.lit(0), F.size(m) - 1), start, step, lambda acc: acc["out"])

        return F.when(F.size(m) > 0, let(F.split(text, form, -1), walk)).otherwise(F.expr("cast(array() as array<struct<s:int,m:string>>)"))

    return let(found, places)


def luhn(digits: Column) -> Column:
    """Whether 13 to 19 digits pass the Luhn check."""
    each = F.transform(F.split(F.reverse(digits), ""), lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(2 * d.cast("int") - F.when(d.cast("int") > 4, 9).otherwise(0)))
    total = F.aggregate(F.filter(each, lambda x: x.isNotNull()), F.lit(0), lambda a, x: a + x)
    return F.when(F.length(digits).between(13, 19), total % 10 == 0).otherwise(F.lit(False))


_OCTET = "0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"


def _octets(m: Column) -> Column:
    return m.rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$")


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def passes(kind: str, m: Column) -> Column:
    """A base pattern's check."""
    if kind == "ip":
        return _octets(m)
    if kind == "card":
        return luhn(_digits(m))
    if kind == "phone":
        return F.length(_digits(m)).between(9, 15)
    return F.lit(True)


SPAN = "struct<kind:int,s:int,e:int,m:string,gen:int>"


def candidates(text: Column) -> Column:
    """All generated spans of a text: array of (kind, s, e, m, gen); overlapping ones included."""
    found = []
    for g, (kind, form, needs, _) in enumerate(GENERATORS):
        spans = F.transform(_starts(text, form), lambda x: F.struct(F.lit(KINDS.index(kind)).alias("kind"), x["s"].alias("s"), (x["s"] + F.length(x["m"])).alias("e"), x["m"].alias("m"), F.lit(g).alias("gen")))
        found.append(F.when(F.contains(text, F.lit(needs)), spans).otherwise(F.expr(f"cast(array() as array<{SPAN}>)")) if needs else spans)
    return F.when(text.rlike("[0-9@]|[(\\[{]at[)\\]}]"), F.concat(*found)).otherwise(F.expr(f"cast(array() as array<{SPAN}>)"))


def base_spans(found: Column) -> Column:
    """The candidates that are base spans."""
    ok = F.lit(False)

    def keep(x: Column) -> Column:
        good = ok
        for g, (kind, _, _, base) in enumerate(GENERATORS):
            if base:
                good = F.when(x["gen"] == g, passes(kind, x["m"])).otherwise(good)
        return good

    return F.filter(found, keep)


def features(text: Column, x: Column) -> Column:
    """Format and context of a candidate as a struct of doubles."""
    m = x["m"]
    before = F.lower(F.substring(text, F.greatest(x["s"] - CONTEXT, F.lit(0)) + 1, F.least(x["s"], F.lit(CONTEXT))))
    last, following = F.right(before, F.lit(1)), F.substring(text, x["e"] + 1, F.lit(1))
    count = lambda chars: F.length(m) - F.length(F.regexp_replace(m, chars, ""))
    hint = F.lit(False)
    for k, words in enumerate(HINTS):
        hint = F.when(x["kind"] == k, before.rlike(words)).otherwise(hint)
    made = {
        "kind": x["kind"], "length": F.length(m), "digits": count("[0-9]"), "letters": count("[A-Za-z]"), "marks": count("[^0-9A-Za-z]"),
        "groups": F.size(F.filter(F.split(m, "[^0-9]+"), lambda p: p != "")), "luhn": luhn(_digits(m)), "octets": _octets(m),
        "at": F.contains(m, F.lit("@")), "plus": F.startswith(m, F.lit("+")), "hex": m.rlike("^[0-9a-f]+$"),
        "mixed": m.rlike("[0-9]") & m.rlike("[A-Za-z]"), "hint": hint, "any_hint": before.rlike("|".join(HINTS)), "quoted": last.isin('"', "'", "=", ":"),
        "before": last.rlike("[0-9a-z]"), "after": following.rlike("[0-9A-Za-z]"),
    }
    return F.struct(*[F.coalesce(made[k].cast("double"), F.lit(0.0)).alias(k) for k in FEATURES])


def _weak_label(x: Column, f: Column) -> Column:
    """The rules' verdict on a training candidate: its check, or for kinds without one its form and hint."""
    kind = lambda name: x["kind"] == KINDS.index(name)
    return (
        F.when(kind("card"), f["luhn"] == 1)
        .when(kind("ip"), f["octets"] == 1)
        .when(kind("email"), F.lit(True))
        .when(kind("phone"), f["digits"].between(9, 15) & (f["octets"] == 0))
        .when(kind("secret"), (f["mixed"] == 1) & (f["digits"] >= 4) & ((f["hint"] == 1) | (f["hex"] == 1)))
        .otherwise((f["digits"] >= 9) & ((f["hint"] == 1) | (f["letters"] > 1)))
        .cast("double")
    )


def train(docs: DataFrame) -> tuple[list, dict[int, float]] | None:
    """(trees with weights, threshold by kind) from all candidates: those of equal features and label are one row with
    its numbers in either half."""
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.feature import VectorAssembler

    rows = docs.select(F.col("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    rows = fixed(rows, found=candidates(F.col("text")))
    found = rows.select("doc_id", F.explode(F.transform("found", lambda x: F.struct(x.alias("x"), features(F.col("text"), x).alias("f")))).alias("c"))
    half = F.xxhash64("doc_id", "c.x.gen", "c.x.s", "c.x.m") % 2
    each = found.select(half.alias("half"), _weak_label(F.col("c.x"), F.col("c.f")).alias("label"), "c.f.*")
    counts = each.groupBy("label", *FEATURES).agg(F.count_if(F.col("half") == 0).cast("double").alias("fit"), F.count_if(F.col("half") != 0).cast("double").alias("held"))
    kinds = stored(counts, "candidates")
    seen = kinds.where("fit > 0").groupBy("label").agg(F.count("*").alias("n")).collect()  # two rows
    if len(seen) < 2:
        return None
    n = sum(r["n"] for r in seen)
    # in one order, so that sums of weights don't depend on how the rows came
    points = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(kinds.where("fit > 0").repartitionByRange(4 + n // POINTS, *FEATURES, "label").sortWithinPartitions(*FEATURES, "label"))
    # with so many bins, splits are sought among all rows and not among a sample of them
    bins = max(32, math.isqrt(n) + 1)
    model = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, maxBins=bins, stepSize=0.3, seed=11, labelCol="label", weightCol="fit", cacheNodeIds=False).fit(points)

    def tree(node) -> tuple | float:
        if node.subtreeDepth() == 0:
            return node.prediction()
        split = node.split()
        return split.featureIndex(), split.threshold(), tree(node.leftChild()), tree(node.rightChild())

    trees = [(w, tree(t._call_java("rootNode"))) for w, t in zip(model.treeWeights, model.trees)]
    scored = kinds.where("held > 0").select("kind", "label", "held", F.round(probability(trees, F.struct(*FEATURES)), 2).alias("p"))
    by_score = scored.groupBy("kind", "p").agg(F.sum(F.col("label") * F.col("held")).alias("good"), F.sum("held").alias("n")).collect()  # kinds x 101 rows
    limits: dict[int, float] = {}
    for k in range(len(KINDS)):
        good = n = 0.0
        limits[k] = 0.9
        for r in sorted((r for r in by_score if r["kind"] == k), key=lambda r: -r["p"]):
            good, n = good + r["good"], n + r["n"]
            if good / n >= PRECISION and r["p"] >= 0.5:
                limits[k] = min(limits[k], r["p"])
    return trees, limits


def probability(trees: list, f: Column) -> Column:
    """The ensemble's probability as an expression over a struct of features."""

    def value(t) -> Column:
        if not isinstance(t, tuple):
            return F.lit(float(t))
        at, limit, left, right = t
        return F.when(f[FEATURES[at]] <= limit, value(left)).otherwise(value(right))

    margin = F.lit(0.0)
    for w, t in trees:
        margin = margin + F.lit(float(w)) * value(t)
    return 1 / (1 + F.exp(-2 * margin))


SCORED = "struct<s:int,e:int,kind:int,p:double,base:boolean>"


def _added(base: Column, scored: Column) -> Column:
    """Of the scored spans those that touch no base span; of overlapping ones the likelier. One
    sweep over all spans by start."""
    none = F.lit(None).cast(SCORED)
    start = F.struct(F.lit(-1).alias("upto"), none.alias("open"), F.expr(f"cast(array() as array<{SCORED}>)").alias("out"))

    def step(acc: Column, d: Column) -> Column:
        hit = acc["open"].isNotNull() & (acc["open"]["e"] > d["s"])
        flush = F.when(acc["open"].isNotNull(), F.concat(acc["out"], F.array(acc["open"]))).otherwise(acc["out"])
        skip = ~d["base"] & ((d["s"] < acc["upto"]) | (hit & (d["p"] <= acc["open"]["p"])))
        return F.struct(
            F.when(d["base"], F.greatest(acc["upto"], d["e"])).otherwise(acc["upto"]).alias("upto"),
            F.when(skip, acc["open"]).when(d["base"], none).otherwise(d).alias("open"),
            F.when(skip | hit, acc["out"]).otherwise(flush).alias("out"),
        )

    ended = lambda acc: F.when(acc["open"].isNotNull(), F.concat(acc["out"], F.array(acc["open"]))).otherwise(acc["out"])
    own = F.transform(base, lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"), x["kind"].alias("kind"), F.lit(2.0).alias("p"), F.lit(True).alias("base")))
    return F.aggregate(F.array_sort(F.concat(own, scored)), start, step, ended)


def _written(spans: Column) -> Column:
    """kind:start:end by kind as listed, then start, comma-joined."""
    ordered = F.array_sort(F.array_distinct(F.transform(spans, lambda x: F.struct(x["kind"].alias("k"), x["s"].alias("s"), x["e"].alias("e")))))
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(ordered, lambda x: F.concat_ws(":", F.element_at(names, x["k"] + 1), x["s"].cast("string"), x["e"].cast("string"))), ",")


def personal_data(docs: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base (written), spans (written, all) for each row of ``docs``."""
    prepare(docs.sparkSession)
    model = train(docs.select("doc_id", "text"))
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = fixed(rows, found=candidates(F.col("text")))
    rows = fixed(rows, base=base_spans(F.col("found")))
    if model is None:
        rows = rows.withColumn("added", F.expr(f"cast(array() as array<{SCORED}>)"))
    else:
        trees, limits = model
        scores = F.transform("found", lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"), x["kind"].alias("kind"), let(features(F.col("text"), x), lambda f: probability(trees, f)).alias("p"), F.lit(False).alias("base")))
        limits_of = F.array(*[F.lit(limits[k]) for k in range(len(KINDS))])
        rows = fixed(rows, scored=F.filter(scores, lambda x: x["p"] >= F.element_at(limits_of, x["kind"] + 1)))
        rows = fixed(rows.drop("text", "found"), added=F.when(F.size("scored") > 0, _added(F.col("base"), F.col("scored"))).otherwise(F.col("scored")))
    number = lambda k: F.size(F.filter("base", lambda x: x["kind"] == k)).cast("long")
    short = lambda a: F.transform(a, lambda x: F.struct(x["kind"].alias("kind"), x["s"].alias("s"), x["e"].alias("e")))
    return rows.select(
        "doc_id", *[number(k).alias(f"n_{KINDS[k]}") for k in range(4)], _written(F.col("base")).alias("base"),
        _written(F.concat(short("base"), short("added"))).alias("spans"),
    )
