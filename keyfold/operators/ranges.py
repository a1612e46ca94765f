"""Joins on ranges without an equality, as equi-joins on bins.

Two rows can only meet when their intervals overlap. Intervals are binned at a level that
fits their length (bins of 2^level), so each covers at most two bins of its own level however
long it is; a pair meets at the level of its longer interval. Hot bins are dealt into a grid
of cells. No pair is compared twice and no nested loop over the tables is planned.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keyfold.operators.sizing import bounded_broadcast
from keyfold.session import shared_dir

#: Rows of one side that a cell of a bin holds on average; a bin with more is split.
CELL_ROWS = 20_000
#: Level of intervals without a finite length, and of points.
ENDLESS, POINT = 1100, -1100
_LO, _HI, _LEVEL, _BIN, _A, _B = "__kf_lo", "__kf_hi", "__kf_level", "__kf_bin", "__kf_a", "__kf_b"


@dataclass(frozen=True)
class Overlap:
    """Pairs of a condition have overlapping intervals: target columns (low, high) and source
    columns (low, high); a point has the same column twice. Bounds are numbers, dates or times."""
    target: tuple[str, str]
    source: tuple[str, str]


_SIDE = r"(target_table|source_table)\.`?(\w+)`?"


def conjuncts(condition: str) -> list[str]:
    """The parts of a condition joined by AND outside of brackets and quotes; simple BETWEENs
    as two parts."""
    text = re.sub(rf"(?i){_SIDE}\s+BETWEEN\s+{_SIDE}\s+AND\s+{_SIDE}",
                  r"\3.\4 <= \1.\2 AND \1.\2 <= \5.\6", condition)
    parts, depth, start = [], 0, 0
    for m in re.finditer(r"'[^']*'|[()]|(?i:\bAND\b)", text):
        if m.group() in "()":
            depth += 1 if m.group() == "(" else -1
        elif depth == 0 and not m.group().startswith("'"):
            parts.append(text[start:m.start()].strip())
            start = m.end()
    return [*parts, text[start:].strip()]


def has_equality(condition: str) -> bool:
    """Whether some part equates the target with the source, so that Spark can hash on it."""
    for part in conjuncts(condition):
        sides = re.split(r"(?<![<>!=])={1,2}(?!=)|<=>", part)
        if len(sides) == 2:
            names = [set(re.findall(r"\b(target_table|source_table)\.", s)) for s in sides]
            if all(len(n) == 1 for n in names) and names[0] != names[1] and not re.search(r"(?i)\bOR\b", part):
                return True
    return False


def overlap_of(condition: str) -> Overlap | None:
    """The overlap that the plain comparisons of a condition imply: one column of the target
    not above one of the source, and one of the source not above one of the target."""
    found = {}
    for part in conjuncts(condition):
        m = re.fullmatch(rf"{_SIDE}\s*(<=|<|>=|>)\s*{_SIDE}", part)
        if m and m[1] != m[4]:
            low, high = ((m[1], m[2]), (m[4], m[5])) if m[3].startswith("<") else ((m[4], m[5]), (m[1], m[2]))
            found.setdefault(low[0], (low[1], high[1]))
    if len(found) < 2:
        return None
    (t_low, s_high), (s_low, t_high) = found["target_table"], found["source_table"]
    return Overlap((t_low, t_high), (s_low, s_high))


def _number(df: DataFrame, name: str) -> Column:
    """A bound as a double that keeps the order; equal doubles of different bounds only widen
    the search."""
    c, kind = F.col(f"`{name}`"), df.schema[name].dataType.typeName()
    if kind == "date":
        return F.unix_date(c).cast("double")
    if kind == "timestamp":
        return F.unix_micros(c).cast("double")
    if kind == "timestamp_ntz":
        return F.unix_date(c.cast("date")) + (F.hour(c) * 3600 + F.minute(c) * 60 + F.second(c)) / F.lit(86400.0)
    if kind not in ("byte", "short", "integer", "long", "float", "double", "decimal"):
        raise ValueError(f"{name} ({kind}) is no number, date or time, so its range cannot be binned")
    d = c.cast("double")
    return F.when(F.isnan(d), F.lit(float("inf"))).otherwise(d)      # NaN is above every number


def _binned(df: DataFrame, bounds: tuple[str, str], other_levels: list[int]) -> DataFrame:
    """``df`` once per bin in which it can meet a row of the other side: at its own level and
    at each longer level of the other side. Rows with a null bound meet none. Bounds the wrong
    way round are taken as the interval between them, which every partner still overlaps."""
    x, y = _number(df, bounds[0]), _number(df, bounds[1])
    own = _level(F.col(_LO), F.col(_HI))
    levels = F.filter(F.array_union(F.array(own), F.array(*[F.lit(n) for n in other_levels])), lambda n: n >= own)
    at = (df.withColumns({_LO: F.least(x, y), _HI: F.greatest(x, y)}).where(x.isNotNull() & y.isNotNull())
          .withColumn(_LEVEL, F.explode(levels)))
    return at.withColumn(_BIN, F.explode(F.array_distinct(F.array(
        _bin(F.col(_LO), F.col(_LEVEL)), _bin(F.col(_HI), F.col(_LEVEL))))))


def _level(low: Column, high: Column) -> Column:
    length = high - low
    return (F.when(F.isnan(length) | (length == float("inf")), F.lit(ENDLESS)).when(length <= 0, F.lit(POINT))
            .otherwise(F.ceil(F.log2(length)).cast("int")))


def _bin(value: Column, level: Column) -> Column:
    """A row's bin at a level: bins are longer than the level's intervals, so an interval's
    ends lie in one bin or in neighbours. The bin number grows with the value and stays a
    double, which no value overflows. Points are their own bins."""
    width = F.pow(F.lit(2.0), level.cast("double") + 1)
    number = F.when(level == POINT, value).otherwise(F.rint(value / width - 0.5))
    return F.when((level == ENDLESS) | (number == 0.0), F.lit(0.0)).otherwise(number)       # no -0.0 beside 0.0


def pairs(target: DataFrame, source: DataFrame, overlap: Overlap, condition: Column) -> DataFrame:
    """The inner join of ``target`` (alias target_table) and ``source`` (alias source_table) on
    ``condition``, whose pairs all overlap by ``overlap``.

    Rows are replicated once per level of the other side that is longer than their own (few:
    levels are powers of two) and at most twice per level. A pair that shares two bins is kept
    in the one that holds the higher of the two low ends. Bins in which a side has more than
    ``CELL_ROWS`` rows become a grid: rows of one side are dealt over its rows of cells and
    copied over its columns, so a bin with a third of all rows is joined by many tasks. Rows
    are dealt by their content; pass distinct rows where copies may abound."""
    spark = target.sparkSession
    shared_dir(spark)
    own_levels = [                                                    # about 2 * 1100 values at most
        [r[0] for r in df.select(_level(F.least(x, y), F.greatest(x, y)).alias("n"), (x.isNotNull() & y.isNotNull()).alias("ok"))
         .where("ok").select("n").distinct().collect()]
        for df, x, y in ((df, _number(df, b[0]), _number(df, b[1])) for df, b in ((target, overlap.target), (source, overlap.source)))]
    t = _binned(target, overlap.target, own_levels[1])
    s = _binned(source, overlap.source, own_levels[0])
    counts = (t.groupBy(_LEVEL, _BIN).agg(F.count(F.lit(1)).alias("t"), F.lit(0).cast("long").alias("s"))
              .unionByName(s.groupBy(_LEVEL, _BIN).agg(F.lit(0).cast("long").alias("t"), F.count(F.lit(1)).alias("s")))
              .groupBy(_LEVEL, _BIN).agg(F.sum("t").alias("t"), F.sum("s").alias("s")))
    hot = counts.where((F.greatest("t", "s") > CELL_ROWS) & (F.least("t", "s") > 0)).select(
        F.col(_LEVEL).alias("__kf_hl"), F.col(_BIN).alias("__kf_hb"),
        F.ceil(F.col("t") / CELL_ROWS).cast("int").alias("__kf_na"), F.ceil(F.col("s") / CELL_ROWS).cast("int").alias("__kf_nb")).checkpoint()

    def dealt(df: DataFrame, of: list[str], mine: str, other: str, n_mine: str, n_other: str) -> DataFrame:
        with_hot = df.join(bounded_broadcast(hot), (F.col(_LEVEL) == F.col("__kf_hl")) & (F.col(_BIN) == F.col("__kf_hb")), "left")
        # by content, so that a task run again deals its rows alike
        cell = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in of]), F.coalesce(F.col(n_mine), F.lit(1))).cast("int")
        return (with_hot.withColumn(mine, cell)
                .withColumn(other, F.explode(F.sequence(F.lit(0), F.coalesce(F.col(n_other), F.lit(1)) - 1)))
                .drop("__kf_hl", "__kf_hb", "__kf_na", "__kf_nb"))

    t = dealt(t, target.columns, _A, _B, "__kf_na", "__kf_nb").alias("target_table")
    s = dealt(s, source.columns, _B, _A, "__kf_nb", "__kf_na").alias("source_table")
    tc, sc = (lambda c: F.col(f"target_table.{c}")), (lambda c: F.col(f"source_table.{c}"))
    same = [tc(c) == sc(c) for c in (_LEVEL, _BIN, _A, _B)]
    longer = F.greatest(_level(tc(_LO), tc(_HI)), _level(sc(_LO), sc(_HI)))
    once = (tc(_LEVEL) == longer) & (tc(_BIN) == _bin(F.greatest(tc(_LO), sc(_LO)), tc(_LEVEL)))
    on = same[0] & same[1] & same[2] & same[3] & once & condition
    return t.join(s, on, "inner")
