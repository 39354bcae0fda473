"""Driver contract and the skew-safe numbering helper."""

from pyspark.sql import Window
from pyspark.sql import functions as F


def test_contract(spark):
    import __spark_entry__ as E

    qs, sql = E.queries(), E.oracle_sql()
    assert set(sql) <= set(qs)
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["lang", "documents", "chunks", "distinct_digests", "labelled", "pending"]


def test_number_within_hot_key(spark):
    from corpusflow.operators.ranking import number_within

    df = spark.range(0, 30000).withColumn("k", F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 7 == 0, F.lit(None)).otherwise((F.col("id") % 50).cast("string"))).withColumn("o", (F.col("id") * 7919) % 30000)
    a = number_within(df, ["k"], ["o"], out="rn", total="n")
    b = df.withColumn("rn2", F.row_number().over(Window.partitionBy("k").orderBy("o"))).withColumn("n2", F.count("*").over(Window.partitionBy("k")))
    assert a.join(b, "id").filter("rn != rn2 or n != n2").count() == 0
    assert a.count() == 30000


def test_hot_key_is_split_across_tasks(spark):
    """A key holding a third of all rows is spread over several range partitions, so no
    single task numbers the whole group."""
    from corpusflow.operators.ranking import range_tagged

    df = spark.range(0, 60000).withColumn("k", F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") % 500).cast("string")))
    tagged = range_tagged(df, ["k", "id"], 8)
    per_part = {r._rp: r.n for r in tagged.filter("k = 'hot'").groupBy("_rp").agg(F.count("*").alias("n")).collect()}
    hot = sum(per_part.values())
    assert hot == 20000
    assert len(per_part) >= 2
    assert max(per_part.values()) < 0.75 * hot
