from pyspark.sql import functions as F

from keyfold.operators import sizing


def _is_broadcast(df, other):
    plan = other.join(df, "k", "left_semi")._jdf.queryExecution().optimizedPlan().toString()
    return "broadcast" in plan.lower()


def test_measure_counts_rows_and_bytes(spark):
    df = spark.createDataFrame([(1, "abc"), (2, None)], "k long, s string")
    n, b = sizing.measure(df)
    assert n == 2 and b == (8 + 3 + 8) + (8 + 0 + 8)


def test_bounded_broadcast_within_and_beyond(spark):
    df = spark.range(100).withColumnRenamed("id", "k")
    other = spark.range(1000).withColumnRenamed("id", "k")
    assert _is_broadcast(sizing.bounded_broadcast(df, max_rows=100), other)
    assert not _is_broadcast(sizing.bounded_broadcast(df, max_rows=99), other)
    assert not _is_broadcast(sizing.bounded_broadcast(df, max_rows=100, max_bytes=100), other)
    # a known row count above the bound needs no pass at all
    assert not _is_broadcast(sizing.bounded_broadcast(df, known_rows=10**9), other)
    assert _is_broadcast(sizing.bounded_broadcast(df, known_rows=100, max_bytes=None), other)


def test_merge_size_check_uses_bytes(spark):
    from keyfold.operators import merge
    src = spark.range(10).select(F.col("id").alias("k"), F.repeat(F.lit("x"), 1000).alias("op"))
    assert merge._is_small(src, ["k"], "auto", 100, "op", max_bytes=1 << 20)
    assert not merge._is_small(src, ["k"], "auto", 100, "op", max_bytes=5000)
    assert not merge._is_small(src, ["k"], "auto", 5, "op")


def test_row_bytes_of_nested_values(spark):
    df = spark.createDataFrame([([1, 2], {"a": 1})], "xs array<int>, m map<string,int>")
    n, b = sizing.measure(df)
    assert n == 1 and b == (len("[1,2]") + 16) + (len('{"a":1}') + 16)
