import pytest

from keyfold.operators import merge
from tests.conftest import rows

S = "k int, v string, op string"


def _t(spark):
    return spark.createDataFrame([(1, "t1", None), (2, "t2", None), (3, "t3", None), (4, "t4", None),
                                  (5, "t5", None), (None, "tnull", None)], S)


def _s(spark):
    return spark.createDataFrame([(2, "s2", "D"), (3, "s3", "I"), (4, None, None), (5, "s5", "U"),
                                  (6, "s6", "D"), (7, "s7", "I"), (None, "snull", "I")], S)


def test_merge_ops_case_table(spark):
    out = merge.merge_ops(_t(spark), _s(spark), ["k"], "op")
    assert rows(out, "k", "v") == sorted([
        (1, "t1"),          # target only
        (3, "s3"),          # matched, I -> source row
        (4, None),          # matched, null op -> whole source row, nulls included
        (5, "t5"),          # matched, other op -> target stays
        (7, "s7"),          # not matched -> insert
        (None, "tnull"),    # null key in target stays
        (None, "snull"),    # null key in source is inserted
    ], key=lambda t: tuple(str(x) for x in t))


def test_unmatched_delete_insert(spark):
    out = merge.merge_ops(_t(spark), _s(spark), ["k"], "op", unmatched_delete="insert")
    assert (6, "s6") in rows(out, "k", "v")


def test_merge_twice_equals_once(spark):
    # null keys never match, so a null-key change would be inserted again; the
    # pipeline drops them before merging
    src = _s(spark).where("k IS NOT NULL")
    once = merge.merge_ops(_t(spark), src, ["k"], "op")
    twice = merge.merge_ops(once, src, ["k"], "op")
    assert rows(once) == rows(twice)


def test_upsert_and_condition(spark):
    out = merge.merge_upsert(_t(spark), _s(spark), ["k"])
    got = dict((k, v) for k, v in rows(out, "k", "v") if k is not None)
    assert got[2] == "s2" and got[5] == "s5" and got[6] == "s6" and got[1] == "t1"
    out = merge.merge_condition(_t(spark), _s(spark),
                                "target_table.k = source_table.k AND source_table.v > target_table.v")
    kv = rows(out, "k", "v")
    assert (2, "s2") in kv and (1, "t1") in kv


def test_coalesce_keeps_target_value_and_null_op(spark):
    out = merge.merge_coalesce(_t(spark), _s(spark), ["k"], op_col="op")
    got = {k: (v, op) for k, v, op in rows(out, "k", "v", "op") if k is not None}
    assert 2 not in got and 6 not in got          # op D dropped
    assert got[4] == ("t4", None)                  # source null does not overwrite; null op kept
    assert got[5] == ("s5", "U")


def test_schema_evolution(spark):
    t = spark.createDataFrame([(1, "a")], "k int, v string")
    s = spark.createDataFrame([(1, "b", 9), (2, "c", 8)], "k int, v string, extra int")
    assert rows(merge.merge_upsert(t, s, ["k"]), "k", "v", "extra") == [(1, "b", 9), (2, "c", 8)]


def test_first_load_drops_deletes(spark):
    assert rows(merge.first_load(_s(spark), "op"), "k") == sorted(
        [(3,), (4,), (5,), (7,), (None,)], key=lambda t: str(t[0]))


@pytest.mark.parametrize("unmatched_delete", ["skip", "insert"])
def test_broadcast_path_equals_shuffle_path(spark, unmatched_delete):
    for fn, kw in ((merge.merge_ops, {"op_col": "op", "unmatched_delete": unmatched_delete}), (merge.merge_upsert, {})):
        a = fn(_t(spark), _s(spark), ["k"], strategy="shuffle", **kw)
        b = fn(_t(spark), _s(spark), ["k"], strategy="broadcast", **kw)
        assert rows(a) == rows(b)
        plan = b._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan


def test_auto_strategy_bound(spark):
    out = merge.merge_ops(_t(spark), _s(spark), ["k"], "op", strategy="auto", broadcast_max_rows=2)
    assert "SortMergeJoin" in out._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("strategy", ["shuffle", "broadcast"])
def test_repeated_source_key_raises(spark, strategy):
    src = _s(spark).unionByName(spark.createDataFrame([(3, "s3b", "I")], S))
    with pytest.raises(Exception, match="more than once"):
        merge.merge_ops(_t(spark), src, ["k"], "op", strategy=strategy).collect()
    with pytest.raises(Exception, match="more than once"):
        merge.merge_upsert(_t(spark), src, ["k"], strategy=strategy).collect()


def test_repeated_null_keys_are_not_repeated_keys(spark):
    src = _s(spark).unionByName(spark.createDataFrame([(None, "snull2", "I")], S))
    out = merge.merge_ops(_t(spark), src, ["k"], "op", strategy="shuffle")
    assert (None, "snull2") in rows(out, "k", "v")


def test_fold_of_batches_equals_merging_them_in_order(spark):
    import itertools
    ops = ["I", "D", None, "U", "-"]            # "-": the key is not in that batch
    target, batches = [], [[], [], []]
    k = 0
    for seq in itertools.product(ops, repeat=3):
        for present in (True, False):
            k += 1
            if present:
                target.append((k, "t", None))
            for b, op in enumerate(seq):
                if op != "-":
                    batches[b].append((k, f"b{b}", op))
    t = spark.createDataFrame(target, S)
    seq_out = t
    for rows_b in batches:
        seq_out = merge.merge_ops(seq_out, spark.createDataFrame(rows_b, S), ["k"], "op", strategy="shuffle")
    seq_out = spark.createDataFrame(seq_out.collect(), S)       # cut the plan; values only
    allb = spark.createDataFrame([(k_, v, op, b) for b, rows_b in enumerate(batches) for k_, v, op in rows_b],
                                 S + ", batch int")
    folded = merge.fold_changes(allb, ["k"], "op", ["batch"]).drop("batch")
    for strategy in ("shuffle", "broadcast"):
        out = merge.merge_ops(t, folded, ["k"], merge.ACTION, strategy=strategy)
        assert out.columns == ["k", "v", "op"]
        assert rows(out) == rows(seq_out)
    assert rows(merge.first_load(merge.fold_changes(allb, ["k"], "op", ["batch"]).drop("batch"), merge.ACTION)) == \
        rows(merge.merge_ops(t.limit(0), folded, ["k"], merge.ACTION))


def test_plans_agree_on_repeated_target_keys_and_missing_columns(spark):
    target = spark.createDataFrame([(1, "a", "t1"), (1, "b", "t2"), (2, "c", "t3"), (None, "d", "t4"), (5, "e", "t5")],
                                   "k int, v string, only_target string")
    source = spark.createDataFrame([(1, "new", "I"), (2, None, "D"), (3, "ins", "U"), (4, "gone", "D"), (5, "kept", "U"), (None, "n", None)],
                                   "k int, v string, op string")
    got = [rows(merge.merge_ops(target, source, ["k"], "op", strategy=s)) for s in ("shuffle", "broadcast")]
    assert got[0] == got[1]
    assert {(1, "new", "t1", "I"), (1, "new", "t2", "I"), (3, "ins", None, "U"), (5, "e", "t5", None)} < set(got[0]) and len(got[0]) == 6
    up = [rows(merge.merge_upsert(target, source.drop("op"), ["k"], strategy=s)) for s in ("shuffle", "broadcast")]
    assert up[0] == up[1] and {(1, "new", "t1"), (1, "new", "t2")} < set(up[0])


def test_condition_needs_an_equality_and_one_match(spark):
    target = spark.createDataFrame([(1, "a")], "k int, v string")
    source = spark.createDataFrame([(1, "x"), (1, "y")], "k int, v string")
    with pytest.raises(ValueError, match="several source rows"):
        merge.merge_condition(target, source, "target_table.k = source_table.k")
    with pytest.raises(ValueError, match="equality"):
        merge.merge_condition(target, source, "target_table.k < source_table.k")
