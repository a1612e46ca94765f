"""Versions of a table, layer tables with their merges, and evolving appends."""

import uuid

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keyfold.operators import merge, snapshots
from keyfold.operators.snapshots import snapshot_deleted
from keyfold.session import scratch_path
from keyfold.sinks import layers, writes
from keyfold.sinks.evolve import wider
from keyfold.sinks.layers import LayerTable
from tests.conftest import rows


def name():
    return f"t_{uuid.uuid4().hex[:10]}"


def test_versions_history_and_deleted(spark):
    t, path = name(), scratch_path(spark, "t_snap")
    old = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k int, v string")
    new = spark.createDataFrame([(1, "a"), (3, "z")], "k int, v string")
    assert snapshots.save_version(old, t, "WRITE", location=path) == 1
    assert snapshots.save_version(new, t, "WRITE") == 2
    assert snapshots.save_version(spark.createDataFrame([(4, "d", 1)], "k int, v string, extra int"), t, "APPEND", append=True) == 3
    assert rows(snapshots.read_version(spark, t, 1), "k", "v") == [(1, "a"), (2, "b"), (3, "c")]
    assert rows(snapshots.read_version(spark, t, 3), "k", "v", "extra") == [(1, "a", None), (3, "z", None), (4, "d", 1)]
    assert [(r.version, r.num_rows) for r in snapshots.history(spark, t).collect()] == [(3, 3), (2, 2), (1, 3)]
    assert all(r.committed_at for r in snapshots.history(spark, t).collect())
    one, two = snapshots.read_version(spark, t, 1), snapshots.read_version(spark, t, 2)
    gone = snapshot_deleted(one, two, ["k"])
    assert rows(gone, "k", "v") == [(2, "b")]
    assert "PartitionFilters: [isnotnull(version" in one._jdf.queryExecution().executedPlan().toString()


def test_snapshot_deleted_splits_a_hot_key_beyond_the_broadcast_bound(spark, monkeypatch):
    from keyfold.operators import sizing
    old = spark.range(60_000, numPartitions=8).selectExpr(
        "IF(id % 3 = 0, 0, id) AS k", "concat('some payload of a row ', id) AS v")
    new = spark.range(60_000, numPartitions=8).selectExpr("IF(id % 3 = 0, -1, id + 30000) AS k")
    want = old.join(new, "k", "left_anti").count()
    assert snapshot_deleted(old, new, ["k"]).count() == want
    monkeypatch.setattr(sizing, "within", lambda *a: False)
    low = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
           "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10k",
           "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
           "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k"}
    before = {k: spark.conf.get(k, None) for k in low}
    try:
        for k, v in low.items():
            spark.conf.set(k, v)
        out = snapshot_deleted(old, new, ["k"])
        assert len(out.collect()) == want
        assert "skew=true" in out._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def table(spark, keys=(), **kw):
    n = name()
    return LayerTable(spark, n, location=scratch_path(spark, n), keys=keys, **kw)


@pytest.mark.parametrize("strategy", ["auto", "shuffle"])
def test_layer_merge_equals_merge_ops(spark, strategy):
    target = [(k, f"t{k}", None) for k in [*range(40), None]]
    source = [(3, "s3", "I"), (4, None, None), (5, "s5", "D"), (6, "s6", "U"), (77, "s77", "I"), (78, "s78", "D"), (79, "s79", "U"),
              (None, "sn", "I"), (None, "sd", "D")]
    schema = "k int, v string, op string"
    t, s = spark.createDataFrame(target, schema), spark.createDataFrame(source, schema)
    layer = table(spark, ["k"], buckets=5)
    layer.overwrite(t)
    counts = layer.merge(s, "op", strategy=strategy)
    assert rows(layer.read()) == rows(merge.merge_ops(t, s, ["k"], "op"))
    done = {r["outcome"]: r["n"] for r in counts.collect()}
    kept = done.pop("kept")
    assert done == {"updated": 2, "deleted": 1, "left": 1, "inserted": 3, "skipped": 2} and kept <= 37
    with pytest.raises(Exception, match="more than once"):
        layer.merge(spark.createDataFrame([(1, "a", "I"), (1, "b", "I")], schema), "op")


def test_merge_touches_only_its_buckets_and_empties_some(spark):
    layer = table(spark, ["k"], buckets=50)
    layer.overwrite(spark.range(30).selectExpr("id AS k", "id AS v"))
    before = {r["key_bucket"]: r["n"] for r in spark.table(layer.name).groupBy("key_bucket").agg(F.count("*").alias("n")).collect()}
    alone = [r["k"] for r in spark.table(layer.name).collect() if before[r["key_bucket"]] == 1][:2]
    counts = layer.merge(spark.createDataFrame([(k, 0, "D") for k in alone], "k long, v long, op string"), "op")
    assert {r["outcome"]: r["n"] for r in counts.collect()} == {"deleted": 2}          # nothing else was read
    assert rows(layer.read().where("op IS NULL"), "k") == [(k,) for k in sorted({*range(30)} - {*alone}, key=str)]
    assert len(layer._held()) == len(before) - 2


def test_create_if_absent(spark):
    layer = table(spark, ["k"])
    src = spark.createDataFrame([(1, "a", "I"), (2, "b", "D"), (3, "c", None)], "k int, v string, op string")
    assert layer.create_if_absent(src, "op") is False and rows(layer.read(), "k") == [(1,), (3,)]
    assert layer.create_if_absent(src, "op") is True


def test_merge_adds_and_widens_columns(spark):
    layer = table(spark, ["k"])
    layer.overwrite(spark.createDataFrame([(1, 5), (2, 6)], "k int, n int"))
    layer.merge(spark.createDataFrame([(2, 1 << 40, "new"), (3, 7, "x")], "k long, n long, extra string"))
    assert rows(layer.read(), "k", "n", "extra") == [(1, 5, None), (2, 1 << 40, "new"), (3, 7, "x")]
    assert dict(layer.read().dtypes) == {"k": "bigint", "n": "bigint", "extra": "string"}
    layer.merge(spark.createDataFrame([(1, 9)], "k int, n int"))
    assert rows(layer.read(), "k", "n", "extra") == [(1, 9, None), (2, 1 << 40, "new"), (3, 7, "x")]
    with pytest.raises(ValueError, match="key k"):
        layer.merge(spark.createDataFrame([("1", 9)], "k string, n int"))
    with pytest.raises(ValueError, match="no keys"):
        table(spark).merge(spark.range(1))


def test_repeated_load_replaces_its_rows(spark):
    layer = table(spark)
    layer.append(spark.createDataFrame([(1,), (2,)], "k int"), "a")
    layer.append(spark.createDataFrame([(3,)], "k int"), "b")
    layer.append(spark.createDataFrame([(4,)], "k int"), "a")
    assert rows(layer.read()) == [(3,), (4,)]
    layer.overwrite(layer.read().where("k = 3"))
    assert rows(layer.read()) == [(3,)] and len(layer._held()) == 1


def values_of(kind):
    return {"date": "DATE'2024-02-29'", "timestamp_ntz": "TIMESTAMP_NTZ'2024-02-29 12:34:56'"}.get(kind, "7")


KINDS = ["tinyint", "smallint", "int", "bigint", "float", "double", "decimal(10,2)", "decimal(20,0)", "date", "timestamp_ntz", "string", "boolean"]


def test_wider_types_hold_both_and_read_old_files(spark):
    """The lattice is symmetric, and each widening is one that the reader makes of old files."""
    kinds = {k: T.StructType.fromDDL(f"x {k}").fields[0].dataType for k in KINDS}
    widenings = set()
    for a in KINDS:
        for b in KINDS:
            up = wider(kinds[a], kinds[b])
            assert up == wider(kinds[b], kinds[a])
            if up is not None and up != kinds[a]:
                widenings.add((a, up.simpleString()))
    assert ("int", "bigint") in widenings and ("date", "timestamp_ntz") in widenings and ("int", "double") in widenings
    for bad in (("bigint", "double"), ("string", "int"), ("boolean", "int"), ("date", "int")):
        assert wider(kinds[bad[0]], kinds[bad[1]]) is None
    for a, b in sorted(widenings):
        path = scratch_path(spark, "wide")
        old = spark.sql(f"SELECT CAST({values_of(a)} AS {a}) AS x")
        old.write.parquet(path)
        assert rows(spark.read.schema(f"x {b}").parquet(path)) == rows(old.select(F.col("x").cast(b))), (a, b)


@pytest.mark.parametrize("managed", [False, True])
def test_append_to_a_table_that_must_change(spark, managed):
    t = name()
    place = {} if managed else {"location": scratch_path(spark, t)}
    writes.append_write(spark.createDataFrame([(1, 2)], "k int, n int"), t, **place)
    writes.append_write(spark.createDataFrame([(2, 1 << 40, "a")], "k int, n long, v string"), t)
    writes.append_write(spark.createDataFrame([(3,)], "k smallint"), t)
    assert rows(spark.table(t)) == [(1, 2, None), (2, 1 << 40, "a"), (3, None, None)]
    with pytest.raises(ValueError, match="no type holds both"):
        writes.append_write(spark.createDataFrame([("x",)], "n string"), t)
    assert spark.table(t).count() == 3
    spark.sql(f"DROP TABLE {t}")


def test_load_column_names_are_fixed():
    assert (layers.LOAD, layers.BUCKET) == ("load_batch", "key_bucket")
