import pytest

from keyfold.operators import quality as dq
from tests.conftest import rows

SCHEMA = "file_name string, k1 int, k2 int, seq string"


def _files(spark):
    data = [
        ("null_keys", None, None, "1"), ("null_keys", 1, 1, "1"),
        ("dup", 1, 1, "5"), ("dup", 1, 1, "5"),
        ("newer", 1, 1, "5"), ("newer", 1, 1, "6"),
        ("clean", 1, 1, "1"), ("clean", 1, 2, "1"), ("clean", None, 3, "1"), ("clean", None, 3, "1"),
    ]
    listing = spark.createDataFrame([(n,) for n in ("clean", "dup", "empty", "newer", "null_keys")], "file_name string")
    return spark.createDataFrame(data, SCHEMA), listing


def test_verdicts(spark):
    df, listing = _files(spark)
    v = dq.dq_check(df, ["k1", "k2"], "seq", listing=listing)
    assert rows(v, "file_name", "code", "severity") == [
        ("clean", None, None), ("dup", dq.DUPLICATED, "10"), ("empty", dq.EMPTY, "10"),
        ("newer", dq.DUP_NEWER_SEQUENCE, "20"), ("null_keys", dq.KEYS_NULL, "10")]
    # a key with a null part is never a duplicate
    assert rows(v.where("file_name = 'clean'"), "n_rows", "n_dup_keys") == [(4, 0)]


def test_without_sequence_a_repeated_key_is_a_duplicate(spark):
    df, listing = _files(spark)
    v = dq.dq_check(df.drop("seq"), ["k1", "k2"], None, listing=listing)
    assert rows(v.where("file_name = 'newer'"), "code") == [(dq.DUPLICATED,)]


def test_policy_default_and_fatal(spark):
    df, listing = _files(spark)
    v = dq.dq_check(df, ["k1", "k2"], "seq", listing=listing)
    p = dq.dq_policy(v)
    assert rows(p, "file_name", "action") == [("clean", "accept"), ("dup", "reject"), ("empty", "reject"),
                                               ("newer", "accept"), ("null_keys", "accept")]
    p = dq.dq_policy(v, fatal=(dq.DUPLICATED,))
    assert rows(p, "file_name", "action") == [("clean", "accept"), ("dup", "stop"), ("empty", "skip"),
                                               ("newer", "skip"), ("null_keys", "skip")]


def test_verdict_join_and_quarantine(spark):
    df, listing = _files(spark)
    p = dq.dq_policy(dq.dq_check(df, ["k1", "k2"], "seq", listing=listing))
    ok = dq.verdict_join(df, p)
    assert {r.file_name for r in ok.collect()} == {"clean", "newer", "null_keys"}
    bad = dq.rejected_rows(df, p)
    assert {r.file_name for r in bad.collect()} == {"dup"}


def test_single_pass_plan(spark):
    df, listing = _files(spark)
    v = dq.dq_check(df, ["k1", "k2"], "seq")
    plan = v._jdf.queryExecution().executedPlan().toString()
    # one scan of the input; the three nested levels each aggregate map-side
    assert plan.count("Scan ExistingRDD") + plan.count("LocalTableScan") == 1
    assert plan.count("partial_") >= 3
