from pyspark.sql import functions as F

from keyfold.operators import dedupe
from tests.conftest import rows


def test_numeric_string_sequence(spark):
    df = spark.createDataFrame([("a", "9", 1), ("a", "10", 2), ("b", None, 3), ("b", "1", 4)], "k string, seq string, v int")
    out = dedupe.latest_per_key(df, ["k"], "seq")
    assert rows(out, "k", "v") == [("a", 2), ("b", 4)]
    # as plain strings '9' sorts above '10'
    out = dedupe.latest_per_key(df, ["k"], "seq", seq_type="string")
    assert rows(out, "k", "v") == [("a", 1), ("b", 4)]


def test_ties_are_deterministic(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 1, "z"), ("a", 1, "y")], "k string, seq int, v string")
    for n in (1, 3):
        out = dedupe.latest_per_key(df.repartition(n), ["k"], "seq")
        assert rows(out, "v") == [("z",)]


def test_latest_by_file_and_order_before_seq(spark):
    df = spark.createDataFrame([("f1", 1, "a", 5), ("f2", 2, "a", 1), ("f1", 1, "b", 1)], "f string, o int, k string, seq int")
    assert len(dedupe.latest_per_key(df, ["k"], "seq", by=["f"]).collect()) == 3
    out = dedupe.latest_per_key(df, ["k"], "seq", before_seq=[F.col("o")])
    assert rows(out, "k", "f") == [("a", "f2"), ("b", "f1")]


def test_plan_has_group_limit_and_one_exchange(spark):
    df = spark.range(1000).select((F.col("id") % 7).alias("k"), F.col("id").alias("seq"))
    plan = dedupe.latest_per_key(df, ["k"], "seq")._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
    assert plan.count("Exchange hashpartitioning") == 1


def test_drop_null_keys(spark):
    df = spark.createDataFrame([(None, None), (1, None), (1, 2)], "a int, b int")
    assert rows(dedupe.drop_null_keys(df, ["a", "b"], "any")) == [(1, 2)]
    assert rows(dedupe.drop_null_keys(df, ["a", "b"], "all")) == [(1, 2), (1, None)] or \
        sorted(map(tuple, dedupe.drop_null_keys(df, ["a", "b"], "all").collect()), key=str) == sorted([(1, None), (1, 2)], key=str)


def test_dup_keys_and_inspect(spark):
    df = spark.createDataFrame([(1, "x"), (1, "y"), (2, "z"), (None, "n"), (None, "m")], "k int, v string")
    assert rows(dedupe.dup_keys(df, ["k"])) == [(1, 2)]
    assert rows(dedupe.dup_inspect(df, ["k"]), "k", "v", "cnt") == [(1, "x", 2), (1, "y", 2)]


def test_text_sequences_keep_their_order(spark):
    df = spark.createDataFrame([(1, "1.3", "z"), (1, "1.4", "a"), (2, "2025-01-02T10:00", "a"), (2, "2025-01-01T10:00", "z"), (3, "9", "z"), (3, "10", "a")],
                               "k int, s string, v string")
    assert rows(dedupe.latest_per_key(df, ["k"], "s"), "k", "s") == [(1, "1.4"), (2, "2025-01-02T10:00"), (3, "10")]


def test_dup_inspect_splits_a_hot_key_beyond_the_broadcast_bound(spark, monkeypatch):
    from keyfold.operators import sizing
    df = spark.range(60_000, numPartitions=8).selectExpr(
        "IF(id % 3 = 0, 0, id DIV 2) AS k", "concat('some payload of a row ', id) AS v")
    want = df.groupBy("k").count().where("count > 1").agg({"count": "sum"}).first()[0]
    assert dedupe.dup_inspect(df, ["k"]).count() == want
    monkeypatch.setattr(sizing, "within", lambda *a: False)
    low = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
           "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10k",
           "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
           "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k"}
    before = {k: spark.conf.get(k, None) for k in low}
    try:
        for k, v in low.items():
            spark.conf.set(k, v)
        out = dedupe.dup_inspect(df, ["k"])
        assert len(out.collect()) == want
        assert "skew=true" in out._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_text_sequences_of_any_length_are_exact(spark):
    import random
    from decimal import Decimal, getcontext
    getcontext().prec = 200
    pick = random.Random(2)
    texts = ["9" * 30, "5", "-5", "-" + "9" * 30, "0", "-0.0", "0.10", "0.1", "-0.15", "-0.1", "007", "+8", " 9 ", "1e3", ".5", "5.", "1" + "0" * 60,
             "1" + "0" * 60 + ".5", "-1" + "0" * 60 + ".5", "-1" + "0" * 60, "3." + "1" * 50, "3." + "1" * 51]
    for a in texts:
        for b in pick.sample(texts, 9):
            if Decimal(a.strip()) == Decimal(b.strip()):
                continue
            want = max(a, b, key=lambda x: Decimal(x.strip()))
            ROWS.append((len(ROWS) // 2, a, want)), ROWS.append((len(ROWS) // 2, b, want))
    df = spark.createDataFrame(ROWS, "k int, s string, want string")
    got = dedupe.latest_per_key(df, ["k"], "s", tiebreak=[])
    assert got.where("s <> want").collect() == [] and got.count() == len(ROWS) // 2
    mixed = spark.createDataFrame([(1, "-5", 0), (1, "2024-01-02", 1), (2, "2024-01-02", 0), (2, "2024-01-10", 1)], "k int, s string, v int")
    assert sorted((r["k"], r["s"]) for r in dedupe.latest_per_key(mixed, ["k"], "s").collect()) == [(1, "-5"), (2, "2024-01-10")]


ROWS = []
