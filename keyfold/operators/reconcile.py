"""Comparing two tables (two environments, or two versions) on their keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_L, _R, _ROW = "__kf_l", "__kf_r", "__kf_row"
DUPLICATE_KEY = "duplicate_key"


def _per_key(df: DataFrame, keys: list[str], cols: list[str], n_col: str) -> DataFrame:
    """One row per key with the key's row count. Combined map-side (a hot key is
    reduced before the shuffle); the output is partitioned and sorted on the keys,
    which the join reuses. The values are those of the key's row when it is unique."""
    aggs = [F.count(F.lit(1)).alias(n_col)]
    if cols:
        aggs.append(F.any_value(F.struct(*[F.col(f"`{c}`") for c in cols])).alias(_ROW))
    return df.groupBy(*keys).agg(*aggs).select(*keys, *[F.col(f"{_ROW}.`{c}`").alias(c) for c in cols], n_col)


def _diff(c: str) -> Column:
    return ~F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}"))


def reconcile(left: DataFrame, right: DataFrame, keys: Sequence[str],
              columns: Sequence[str] | None = None) -> DataFrame:
    """Rows that differ: ``status`` is ``changed`` (some compared column differs,
    null against value included), ``left_only`` or ``right_only``; each compared
    column appears as ``left_<c>`` and ``right_<c>``.

    A key that repeats on either side is one ``duplicate_key`` row with null
    values: rows are never paired with every copy of their key."""
    keys = list(keys)
    cols = list(columns) if columns is not None else [
        c for c in left.columns if c not in keys and c in right.columns]
    # a null key never matches: those rows are one-sided by definition and bypass
    # the join, so they cannot pile up in one join partition
    any_null = F.lit(False)
    for k in keys:
        any_null = any_null | F.col(k).isNull()
    side = lambda df, tag: df.where(any_null).select(
        *keys, F.lit(tag).alias("status"),
        *[x for c in cols for x in ((F.col(c) if tag == "left_only" else F.lit(None).cast(df.schema[c].dataType)).alias(f"left_{c}"),
                                     (F.col(c) if tag == "right_only" else F.lit(None).cast(df.schema[c].dataType)).alias(f"right_{c}"))])
    null_rows = side(left, "left_only").unionByName(side(right, "right_only"))
    l = _per_key(left.where(~any_null), keys, cols, _L).alias("l")
    r = _per_key(right.where(~any_null), keys, cols, _R).alias("r")
    cond = None
    for k in keys:
        e = F.col(f"l.{k}") == F.col(f"r.{k}")
        cond = e if cond is None else cond & e
    j = l.join(r, cond, "full_outer")
    any_diff = F.lit(False)
    for c in cols:
        any_diff = any_diff | _diff(c)
    dup = (F.coalesce(F.col(f"l.{_L}"), F.lit(0)) > 1) | (F.coalesce(F.col(f"r.{_R}"), F.lit(0)) > 1)
    status = (F.when(dup, F.lit(DUPLICATE_KEY))
              .when(F.col(f"r.{_R}").isNull(), F.lit("left_only"))
              .when(F.col(f"l.{_L}").isNull(), F.lit("right_only"))
              .when(any_diff, F.lit("changed")))
    value = lambda side, c: F.when(~dup, F.col(f"{side}.{c}"))
    out = j.select(*[F.coalesce(F.col(f"l.{k}"), F.col(f"r.{k}")).alias(k) for k in keys],
                   status.alias("status"),
                   *[x for c in cols for x in (value("l", c).alias(f"left_{c}"),
                                                value("r", c).alias(f"right_{c}"))])
    return out.where(F.col("status").isNotNull()).unionByName(null_rows)


def reconcile_copies(left: DataFrame, right: DataFrame, keys: Sequence[str],
                     columns: Sequence[str] | None = None) -> DataFrame:
    """The multiset difference of two tables whose keys may repeat: every content (keys and
    compared columns) that one side holds more often than the other, with ``left_n`` and
    ``right_n``, and ``left_rows`` / ``right_rows`` of its key.

    Contents are counted on both sides in one aggregation of the union; equal copies combine
    map-side, and different copies of a hot key spread by content, so no key's rows meet in
    one task. Nulls equal nulls, in keys too."""
    keys = list(keys)
    cols = list(columns) if columns is not None else [c for c in left.columns if c not in keys and c in right.columns]
    names = [*keys, *cols]
    tagged = [df.select(*[F.col(f"`{c}`") for c in names], F.lit(n).cast("long").alias(_L), F.lit(1 - n).cast("long").alias(_R))
              for df, n in ((left, 1), (right, 0))]
    whole = tagged[0].unionByName(tagged[1])
    both = whole.groupBy(*[F.col(f"`{c}`") for c in names]).agg(F.sum(_L).alias("left_n"), F.sum(_R).alias("right_n"))
    differing = both.where("left_n <> right_n")
    per_key = whole.groupBy(*[F.col(f"`{k}`") for k in keys]).agg(F.sum(_L).alias("left_rows"), F.sum(_R).alias("right_rows"))
    same = F.lit(True)
    for k in keys:
        same = same & F.col(f"d.`{k}`").eqNullSafe(F.col(f"k.`{k}`"))
    return differing.alias("d").join(per_key.alias("k"), same).select("d.*", "left_rows", "right_rows")


def diff_count(recon: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per compared column, the number of matched rows whose values differ; plus
    rows ``(left_only)`` and ``(right_only)``. One aggregation, then unpivot."""
    aggs = [F.count_if((F.col("status") == "changed") &
                       ~F.col(f"left_{c}").eqNullSafe(F.col(f"right_{c}"))).alias(c) for c in columns]
    aggs += [F.count_if(F.col("status") == "left_only").alias("(left_only)"),
             F.count_if(F.col("status") == "right_only").alias("(right_only)")]
    wide = recon.agg(*aggs)
    names = [*columns, "(left_only)", "(right_only)"]
    return wide.select(F.explode(F.array(*[
        F.struct(F.lit(n).alias("column_name"), F.col(f"`{n}`").cast("long").alias("n_diff"))
        for n in names])).alias("x")).select("x.*")
