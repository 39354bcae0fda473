"""Quality rules by distribution divergence.

Each language's reference is what all its documents hold: how characters spread over classes and
how words spread over the language's common words (those that make at least ``COMMON_SHARE`` of its
words, so at most 1 / COMMON_SHARE of them). They are counted exactly: words up to ``SHORT`` letters each, longer ones by
buckets of a hash first and then each in those buckets that reach the share. A document is
dropped if its own histogram lies beyond a Jensen-Shannon distance of the reference, when it is long
enough for the histogram to mean something, or if it fails the base rules (too short, too repetitive).

Defined results: a null text has no words (and fails the base rules); a null language is a language
of its own; a language without common words is judged by characters only; repeated rows get equal
results and all count for the reference; an empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE_RUN, count_of, fixed, let, prepare, shingle_hash, stored, word_hashes, word_string

# Fixed values of the base rules.
SYMBOLS = "#*$%&|<>"
REPEAT_WINDOW = 8
LEAST_WORDS = 20
MOST_REPEATED = 30  # of 100 words

COMMON_SHARE = 0.01
#: Words of more letters are counted by so many hash buckets first.
SHORT, BUCKETS = 4, 4_096
#: Beyond these distances (0 to 1) a document is dropped; shorter documents are not judged. By rule: the least hundredth that
#: no document labelled good reaches on the labelled 10,000 documents (their largest distances: 0.309 and 0.277).
CHAR_DISTANCE, CHAR_LEAST = 0.31, 200
WORD_DISTANCE, WORD_LEAST = 0.28, 60
#: Character classes, in order, as sets; what none of them takes is the last class, "other".
CLASSES = (("consonant", "b-df-hj-np-tv-z"), ("vowel", "aeiou"), ("upper", "A-Z"), ("digit", "0-9"), ("blank", r"\x20\x09-\x0D"), ("stop", ".,;:'\"-"), ("symbol", r"!?()\[\]{}/\\+=~^`@_#*$%&|<>"))


def class_counts(text: Column) -> Column:
    """Array of the characters of each class: each class is taken out of what the ones before left."""

    def taken(rest: Column, classes: tuple) -> Column:
        if not classes:
            return F.array(F.length(rest).cast("long"))
        left = F.regexp_replace(rest, f"[{classes[0][1]}]+", "")
        return let(left, lambda x: F.concat(F.array((F.length(rest) - F.length(x)).cast("long")), taken(x, classes[1:])))

    return taken(text, CLASSES)


def flat_words(text: Column) -> Column:
    """The words ``[^\\x20\\x09-\\x0D]+`` with one blank between them."""
    return F.trim(F.regexp_replace(text, SPACE_RUN, " "))


def repeated_words(words: Column, window: int = REPEAT_WINDOW) -> Column:
    """Words inside a window of ``window`` words that is found twice or more in the text.

    Windows are told apart by a 64-bit hash. Only texts with an equal pair are sorted."""
    places = F.when(F.size(words) >= window, F.sequence(F.lit(0), F.size(words) - window)).otherwise(F.expr("cast(array() as array<int>)"))
    hashes = let(word_hashes(words), lambda h: F.transform(places, lambda i: shingle_hash(h, i, window)))

    def cover(h: Column) -> Column:
        pairs = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        twice = lambda s: F.filter(
            F.transform(
                s,
                lambda x, k: F.when((F.get(s, k - 1)["h"] == x["h"]) | (F.get(s, k + 1)["h"] == x["h"]), x["i"]),
            ),
            lambda i: i.isNotNull(),
        )
        ordered = let(pairs, lambda s: F.array_sort(twice(s)))
        reach = lambda p: F.aggregate(
            F.transform(p, lambda i, k: F.least(F.lit(window), F.coalesce(F.get(p, k + 1) - i, F.lit(window)))), F.lit(0), lambda a, x: a + x
        )
        return let(ordered, reach)

    return let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) < F.size(h), cover(h)).otherwise(0))


def _repeat_lines(text: Column) -> Column:
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x)))


def base_columns(docs: DataFrame) -> DataFrame:
    """``docs(doc_id, text, lang, ..)`` to doc_id, lang, words (a word string), and the base columns."""
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), "lang")
    rows = fixed(rows, flat=flat_words(F.col("text")))
    rows = fixed(rows, tokens=F.when(F.col("flat") == "", F.expr("cast(array() as array<string>)")).otherwise(F.split("flat", " ")))
    rows = fixed(
        rows,
        n_words=F.size("tokens").cast("long"),
        word_chars=(F.length("flat") - F.greatest(F.size("tokens") - 1, F.lit(0))).cast("long"),
        n_symbols=count_of(F.col("text"), f"[{SYMBOLS}]+").cast("long"),
        n_dup_lines=_repeat_lines(F.col("text")).cast("long"),
        n_repeat_words=repeated_words(F.col("tokens")).cast("long"),
        classes=class_counts(F.col("text")),
        n_chars=F.length("text"),
        words=word_string(F.col("text")),
    )
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    return rows.drop("text", "flat", "tokens").withColumn("base_failed", failed)


def _common_words(rows: DataFrame) -> DataFrame:
    """``(lang, word, n, total)`` of each language's common words, counted over all documents ``rows(lang, words)``."""
    words = rows.select("lang", F.explode(F.split("words", " ")).alias("word")).where("word != ''")
    bucket = F.concat(F.lit("#"), F.pmod(F.xxhash64("word"), F.lit(BUCKETS)).cast("string"))  # no word has this mark
    key = F.when(F.length("word") <= SHORT, F.col("word")).otherwise(bucket)
    counts = stored(words.groupBy("lang", key.alias("word")).agg(F.count("*").alias("n")), "counts")
    totals = counts.groupBy("lang").agg(F.sum("n").alias("total")).withColumnRenamed("lang", "_lang")
    often = counts.join(totals, F.col("lang").eqNullSafe(F.col("_lang"))).drop("_lang").where(F.col("n") >= COMMON_SHARE * F.col("total"))
    often = stored(often, "often")  # at most 1 / COMMON_SHARE rows a language
    common = often.where("word not like '#%'")
    full = often.where("word like '#%'")
    if full.isEmpty():
        return common
    # a bucket that reaches the share may hold a common word: these words one by one
    full = full.select(F.col("lang").alias("_lang"), F.col("word").alias("_bucket"), "total")
    long = words.where(F.length("word") > SHORT).join(full, F.col("lang").eqNullSafe(F.col("_lang")) & (bucket == F.col("_bucket")))
    long = long.groupBy("lang", "word", "total").agg(F.count("*").alias("n")).where(F.col("n") >= COMMON_SHARE * F.col("total"))
    return common.unionByName(long)


def references(docs: DataFrame) -> DataFrame:
    """A row a language of ``docs(text, lang, ..)``: lang, class_shares, common (words), word_shares (theirs, and the rest's last)."""
    prepare(docs.sparkSession)
    return _references(docs.select("lang", class_counts(F.coalesce("text", F.lit(""))).alias("classes"), word_string(F.col("text")).alias("words")))


def _references(rows: DataFrame) -> DataFrame:
    """:func:`references` of ``rows(lang, classes, words)``."""
    sums = rows.select("lang", F.posexplode("classes").alias("k", "n")).groupBy("lang", "k").agg(F.sum("n").alias("n"))
    by_class = sums.groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("k", "n"))).alias("c"))
    total = F.greatest(F.lit(1).cast("long"), F.aggregate("c", F.lit(0).cast("long"), lambda s, y: s + y["n"]))  # empty texts only: all shares 0
    chars = by_class.select("lang", F.transform("c", lambda x: x["n"] / total).alias("class_shares"))
    words = _common_words(rows).groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("word", (F.col("n") / F.col("total")).alias("share")))).alias("w"))
    rest = F.greatest(F.lit(0.0), 1 - F.aggregate("w", F.lit(0.0), lambda s, x: s + x["share"]))
    words = words.select("lang", F.transform("w", lambda x: x["word"]).alias("common"), F.concat(F.transform("w", lambda x: x["share"]), F.array(rest)).alias("word_shares"))
    met = chars.alias("c").join(words.alias("w"), F.col("c.lang").eqNullSafe(F.col("w.lang")), "left")
    return stored(met.select(F.col("c.lang").alias("lang"), "class_shares", F.coalesce("common", F.expr("cast(array() as array<string>)")).alias("common"), F.coalesce("word_shares", F.array(F.lit(1.0))).alias("word_shares")), "references")


def js_distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance (base 2, 0 to 1) of two arrays of shares."""
    part = lambda a, m: F.when(a > 0, a * F.log2(a / m)).otherwise(0.0)
    terms = F.zip_with(p, q, lambda a, b: part(a, (a + b) / 2) + part(b, (a + b) / 2))
    return F.sqrt(F.greatest(F.lit(0.0), F.aggregate(terms, F.lit(0.0), lambda s, x: s + x) / 2))


def quality(docs: DataFrame, char_distance: float = CHAR_DISTANCE, word_distance: float = WORD_DISTANCE) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept and both
    distances (null where the document is too short to be judged) for each row of ``docs``."""
    prepare(docs.sparkSession)
    rows = stored(base_columns(docs), "base")  # each text's classes and words are made once, for the references and for its distances
    refs = _references(rows)
    # words longer than the language's longest common word can't be one
    longest = F.aggregate("common", F.lit(0), lambda s, w: F.greatest(s, F.length(w)))
    refs = refs.withColumnRenamed("lang", "ref_lang").withColumn("longer", F.concat(F.lit(" [^ ]{"), (longest + 1).cast("string"), F.lit(",} ")))
    rows = rows.join(refs, rows["lang"].eqNullSafe(refs["ref_lang"]), "left")
    padded = F.concat(F.lit(" "), F.replace("words", F.lit(" "), F.lit("  ")), F.lit(" "))
    rows = fixed(rows, short=F.regexp_replace(padded, F.col("longer"), F.lit(""))).drop("words")
    occurs = lambda c: (F.length("short") - F.length(F.replace("short", F.concat(F.lit(" "), c, F.lit(" ")), F.lit("")))) / (F.length(c) + 2)
    rows = fixed(rows, counts=F.transform("common", occurs))
    own = F.concat(F.col("counts"), F.array(F.greatest(F.lit(0.0), F.col("n_words") - F.aggregate("counts", F.lit(0.0), lambda s, x: s + x))))
    shares = lambda a: let(F.aggregate(a, F.lit(0.0), lambda s, x: s + x), lambda n: F.transform(a, lambda x: x / n))
    chars = F.when(F.col("n_chars") >= CHAR_LEAST, js_distance(shares(F.col("classes")), F.col("class_shares")))
    words = F.when((F.col("n_words") >= WORD_LEAST) & (F.size("common") > 0), js_distance(shares(own), F.col("word_shares")))
    rows = fixed(rows, char_distance=chars, word_distance=words)
    far = (F.coalesce("char_distance", F.lit(0.0)) > char_distance) | (F.coalesce("word_distance", F.lit(0.0)) > word_distance)
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", (~F.col("base_failed") & ~far).alias("kept"), "char_distance", "word_distance")
