"""Size checks before a broadcast.

A side is broadcast only when its size is known to be within a bound: either
the caller knows the row count (e.g. one row per landed file), or one
distributed pass counts rows and bytes (partial aggregation, no single task).
Above the bound the join is left to the planner, which shuffles both sides
(AQE may still pick a broadcast from the measured size of a finished stage).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Defaults for tables with one row per file, partition or lookup entry.
SMALL_MAX_ROWS = 500_000
SMALL_MAX_BYTES = 128 << 20


def row_bytes(df: DataFrame, columns: Sequence[str] | None = None) -> Column:
    """Upper estimate of a row's size in memory: fixed widths for primitive types,
    the byte length (+ 8 for the offset) for strings and binaries, the JSON length
    for nested values."""
    total = F.lit(0).cast("long")
    for f in df.schema.fields:
        if columns is not None and f.name not in columns:
            continue
        c, t = F.col(f"`{f.name}`"), f.dataType
        if isinstance(t, (T.StringType, T.BinaryType)):
            size = F.coalesce(F.octet_length(c), F.lit(0)) + 8
        elif isinstance(t, (T.ArrayType, T.MapType, T.StructType)):
            size = F.coalesce(F.octet_length(F.to_json(c)), F.lit(0)) + 16
        elif isinstance(t, T.DecimalType):
            size = F.lit(16)
        else:                                   # numbers, dates, timestamps, booleans
            size = F.lit(8)
        total = total + size.cast("long")
    return total


def measure(df: DataFrame) -> tuple[int, int]:
    """(rows, bytes) of ``df`` in one distributed pass."""
    r = df.agg(F.count(F.lit(1)).alias("n"), F.sum(row_bytes(df)).alias("b")).first()
    return int(r["n"]), int(r["b"] or 0)


def within(df: DataFrame, max_rows: int, max_bytes: int | None = None) -> bool:
    """True if ``df`` has at most ``max_rows`` rows (and ``max_bytes`` bytes)."""
    if max_bytes is None:
        return df.count() <= max_rows
    n, b = measure(df)
    return n <= max_rows and b <= max_bytes


def bounded_broadcast(df: DataFrame, *, known_rows: int | None = None,
                      max_rows: int = SMALL_MAX_ROWS, max_bytes: int | None = SMALL_MAX_BYTES) -> DataFrame:
    """``broadcast(df)`` when its size is proven within the bound, else ``df``.

    ``known_rows``: a row count the caller already holds. Above ``max_rows`` it
    rules the broadcast out without a pass; within it, only the bytes are measured
    (and nothing at all when ``max_bytes`` is None)."""
    if known_rows is not None:
        if known_rows > max_rows:
            return df
        if max_bytes is None:
            return F.broadcast(df)
    if within(df, max_rows, max_bytes):
        return F.broadcast(df)
    return df
