from keyfold.operators import reconcile
from tests.conftest import rows


def test_reconcile_cases(spark):
    left = spark.createDataFrame([(1, "a"), (2, "b"), (3, None), (4, None), (5, "e")], "k int, c string")
    right = spark.createDataFrame([(1, "a"), (2, "x"), (3, "c"), (4, None), (6, "f")], "k int, c string")
    out = reconcile.reconcile(left, right, ["k"])
    assert rows(out, "k", "status") == [(2, "changed"), (3, "changed"), (5, "left_only"), (6, "right_only")]
    dc = {r.column_name: r.n_diff for r in reconcile.diff_count(out, ["c"]).collect()}
    assert dc == {"c": 2, "(left_only)": 1, "(right_only)": 1}


def test_null_keys_are_one_sided(spark):
    left = spark.createDataFrame([(None, "a"), (1, "b")], "k int, c string")
    right = spark.createDataFrame([(None, "a"), (1, "b")], "k int, c string")
    out = reconcile.reconcile(left, right, ["k"])
    assert rows(out, "k", "status") == [(None, "left_only"), (None, "right_only")]


def test_repeated_key_is_one_row_not_pairs(spark):
    # key 7 repeats 3 times on the left and 4 times on the right: a join would emit 12 pairs
    left = spark.createDataFrame([(7, "a")] * 3 + [(1, "x"), (2, "y")], "k int, c string")
    right = spark.createDataFrame([(7, "a")] * 4 + [(1, "x"), (2, "z"), (3, "w"), (3, "w")], "k int, c string")
    out = reconcile.reconcile(left, right, ["k"])
    assert rows(out, "k", "status", "left_c", "right_c") == [
        (2, "changed", "y", "z"), (3, "duplicate_key", None, None), (7, "duplicate_key", None, None)]


def test_left_only_keeps_values(spark):
    left = spark.createDataFrame([(1, "a"), (2, "b")], "k int, c string")
    right = spark.createDataFrame([(1, "a")], "k int, c string")
    out = reconcile.reconcile(left, right, ["k"])
    assert rows(out, "k", "status", "left_c", "right_c") == [(2, "left_only", "b", None)]


def test_copies_that_differ_are_counted(spark):
    from keyfold.operators.reconcile import reconcile_copies
    left = [(1, "a")] * 3 + [(1, "b"), (2, "x"), (3, None), (None, "n"), (None, "n"), (4, "same")]
    right = [(1, "a")] * 2 + [(1, "c"), (2, "x"), (3, "v"), (None, "n"), (5, "new"), (4, "same")]
    got = reconcile_copies(*[spark.createDataFrame(r, "k int, v string") for r in (left, right)], ["k"])
    assert got.columns == ["k", "v", "left_n", "right_n", "left_rows", "right_rows"]
    assert sorted(map(tuple, got.collect()), key=str) == sorted([
        (1, "a", 3, 2, 4, 3), (1, "b", 1, 0, 4, 3), (1, "c", 0, 1, 4, 3), (3, None, 1, 0, 1, 1), (3, "v", 0, 1, 1, 1),
        (None, "n", 2, 1, 2, 1), (5, "new", 0, 1, 0, 1)], key=str)
