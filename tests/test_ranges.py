"""Merges on ranges: binned joins against every pair."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from keyfold.operators import merge, ranges

INF, NAN = float("inf"), float("nan")


def pairs_of(spark, target, source, condition, overlap=None, kind="double"):
    t = spark.createDataFrame(target, f"tid int, lo {kind}, hi {kind}").repartition(3)
    s = spark.createDataFrame(source, f"sid int, p {kind}, q {kind}").repartition(2)
    overlap = overlap or ranges.overlap_of(condition)
    found = ranges.pairs(t, s, overlap, F.expr(condition))
    text = found._jdf.queryExecution().sparkPlan().toString()
    assert "NestedLoop" not in text and "Cartesian" not in text
    return sorted((r["tid"], r["sid"]) for r in found.select("tid", "sid").collect())


def values(pick, n):
    """Intervals from points to endless ones, some the wrong way round or without a bound."""
    out = []
    for i in range(n):
        x, length = pick.uniform(-50, 50), pick.choice([0, 0, 1e-9, 0.3, 1, 7, 60, 1e6])
        row = pick.choice([(x, x + length)] * 12 + [(x + length, x), (None, x), (x, None), (-INF, x), (x, INF), (x, NAN), (0.0, -0.0), (1e300, -1e300)])
        out.append((i, *row))
    return out


@pytest.mark.parametrize("cell_rows", [3, ranges.CELL_ROWS])
def test_overlaps_equal_every_pair(spark, monkeypatch, cell_rows):
    monkeypatch.setattr(ranges, "CELL_ROWS", cell_rows)
    pick = random.Random(5)
    target, source = values(pick, 90), values(pick, 70)
    above = lambda a, b: a is not None and b is not None and ((a <= b) if a == a and b == b else b != b)  # noqa: E731  NaN on top
    got = pairs_of(spark, target, source, "target_table.lo <= source_table.q AND source_table.p <= target_table.hi")
    assert got == sorted((t, s) for t, lo, hi in target for s, p, q in source if above(lo, q) and above(p, hi))
    assert len(got) > 300


def test_points_in_intervals(spark):
    pick = random.Random(8)
    target = [(i, x, x + pick.choice([1, 5, 400])) for i, x in enumerate(pick.randrange(1000) for _ in range(200))]
    source = [(i, x, 0) for i, x in enumerate(pick.randrange(1000) for _ in range(300))]
    want = sorted((t, s) for t, lo, hi in target for s, p, _ in source if lo <= p < hi)
    for condition in ("target_table.lo <= source_table.p AND source_table.p < target_table.hi",
                      "target_table.hi > source_table.p and (source_table.q = 0) AND source_table.p >= target_table.lo"):
        assert pairs_of(spark, target, source, condition, kind="long") == want


def test_dates_and_times(spark):
    day = lambda k: dt.date(1969, 12, 1) + dt.timedelta(k)
    rows = [(i, day(3 * i), day(3 * i + i % 40)) for i in range(60)]
    points = [(i, day(2 * i), day(2 * i)) for i in range(90)]
    want = sorted((t, s) for t, lo, hi in rows for s, p, _ in points if lo <= p <= hi)
    condition = "source_table.p BETWEEN target_table.lo AND target_table.hi"
    assert pairs_of(spark, rows, points, condition, kind="date") == want
    at = lambda d: dt.datetime(d.year, d.month, d.day, 23, 59, 59, 999999)
    for kind in ("timestamp", "timestamp_ntz"):
        assert pairs_of(spark, [(i, at(a), at(b)) for i, a, b in rows], [(i, at(a), at(b)) for i, a, b in points], condition, kind=kind) == want


def test_a_third_of_the_rows_in_one_bin(spark, monkeypatch):
    """The hot bin becomes a grid; every pair is still found once."""
    monkeypatch.setattr(ranges, "CELL_ROWS", 50)
    target = [(i, 500.0, 501.0) if i % 3 == 0 else (i, float(i), float(i) + 0.5) for i in range(900)]
    source = [(i, 500.5, 500.5) if i % 3 == 0 else (i, i * 2.0, i * 2.0) for i in range(300)]
    got = pairs_of(spark, target, source, "target_table.lo <= source_table.p AND source_table.p <= target_table.hi")
    assert got == sorted((t, s) for t, lo, hi in target for s, p, _ in source if lo <= p <= hi) and len(got) >= 30_000


def test_parsing():
    assert ranges.conjuncts("a = 1 AND (b = 2 AND c = 3) and d = 'x AND y'") == ["a = 1", "(b = 2 AND c = 3)", "d = 'x AND y'"]
    assert ranges.has_equality("target_table.a + 1 = source_table.b AND source_table.c > 2")
    for text in ("target_table.a <= source_table.b", "target_table.a = 3", "target_table.a = source_table.a OR true",
                 "target_table.a != source_table.a", "target_table.a = target_table.b"):
        assert not ranges.has_equality(text)
    assert ranges.overlap_of("target_table.a < source_table.b AND target_table.c > source_table.d") == ranges.Overlap(("a", "c"), ("d", "b"))
    assert ranges.overlap_of("target_table.a < source_table.b AND target_table.c < source_table.d") is None


def test_text_bounds_raise(spark):
    with pytest.raises(ValueError, match="no number"):
        pairs_of(spark, [(1, "a", "b")], [(1, "a", "b")], "target_table.lo <= source_table.q AND source_table.p <= target_table.hi", kind="string")


def test_range_merge(spark):
    """All actions, repeated target rows, null bounds; a target row met by two sources raises."""
    target = spark.createDataFrame([(1, 5.0, "a"), (2, 15.0, "b"), (2, 15.0, "b"), (3, 25.0, "c"), (4, None, "d"), (5, 99.0, "e")],
                                   "k int, x double, v string")
    bands = [(0.0, 10.0, "A", "I"), (10.0, 20.0, "B", None), (20.0, 30.0, "C", "D"), (40.0, 50.0, "F", "D"),
             (50.0, 60.0, "G", "U"), (None, 70.0, "H", "I"), (90.0, 100.0, "E", "U")]
    schema = "lo double, hi double, v string, op string"
    condition = "source_table.lo <= target_table.x AND target_table.x < source_table.hi"
    out = merge.merge_condition(target, spark.createDataFrame(bands, schema), condition, op_col="op")
    assert out.columns == ["k", "x", "v", "lo", "hi", "op"]
    got = sorted((tuple(r) for r in out.collect()), key=str)
    assert got == sorted([(1, 5.0, "A", 0.0, 10.0, "I"), (2, 15.0, "B", 10.0, 20.0, None), (2, 15.0, "B", 10.0, 20.0, None),
                          (4, None, "d", None, None, None), (5, 99.0, "e", None, None, None),
                          (None, None, "G", 50.0, 60.0, "U"), (None, None, "H", None, 70.0, "I")], key=str)
    with pytest.raises(ValueError, match="several source rows"):
        merge.merge_condition(target, spark.createDataFrame([*bands, (4.0, 6.0, "Z", "I")], schema), condition, op_col="op")
    empty = spark.createDataFrame([], schema)
    assert merge.merge_condition(target, empty, condition, op_col="op").count() == 6
    assert merge.merge_condition(target.where("false"), spark.createDataFrame(bands, schema), condition, op_col="op").count() == 5
