"""Dense indexes: global and per group, incl. a hot group spread over partitions."""
from pyspark.sql import functions as F
from pyspark.sql import Window

from textmill.operators.index import dense_index, dense_index_within


def test_dense_index_global(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 5000).alias("k"))
    out = dense_index(df, ["k"], num_partitions=7).collect()
    assert sorted((r["k"], r["rn"]) for r in out) == [(i, i) for i in range(5000)]


def test_dense_index_within_hot_group_and_big_keys(spark):
    # one key holds most rows; 64-bit keys must survive exactly; nullable payload
    rows = [(1 << 60 if i % 3 else i, i, None if i % 5 else i) for i in range(3000)]
    df = spark.createDataFrame(rows, "k long, o long, payload long")
    got = dense_index_within(df, ["k"], ["o"], out="idx", num_partitions=6)
    w = Window.partitionBy("k").orderBy("o")
    want = df.withColumn("idx", F.row_number().over(w) - 1)
    assert sorted(map(tuple, got.select("k", "o", "payload", "idx").collect())) == \
        sorted(map(tuple, want.select("k", "o", "payload", "idx").collect()))


def test_dense_index_large_with_payload(spark):
    # the counts must come from the same partitioning as the rows
    n = 150_000
    df = spark.range(0, n, 1, 16).select(F.xxhash64("id").alias("k"), F.repeat(F.lit("payload "), 12).alias("text"))
    got = dense_index(df, ["k"], num_partitions=16)
    row = got.agg(F.count("*").alias("n"), F.countDistinct("rn").alias("d"), F.min("rn").alias("lo"), F.max("rn").alias("hi")).first()
    assert tuple(row) == (n, n, 0, n - 1)
    assert got.orderBy("rn").select("k").limit(500).collect() == got.orderBy("k").select("k").limit(500).collect()


def test_dense_index_within_null_keys(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), (None, 3), (5, 1), (5, 2)], "k long, o long")
    got = dense_index_within(df, ["k"], ["o"], out="idx", num_partitions=2).collect()
    assert sorted((r["k"] or 0, r["o"], r["idx"]) for r in got) == [(0, 1, 0), (0, 2, 1), (0, 3, 2), (5, 1, 0), (5, 2, 1)]
