"""Column transforms used by the layer hooks, and the output-schema check."""

from __future__ import annotations

import warnings
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def add_source(df: DataFrame, source: str, col: str = "SOURCE") -> DataFrame:
    return df.withColumn(col, F.lit(source))


def business_date_from_file(df: DataFrame, file_col: str, sub_entity: str,
                            col: str = "BUSINESS_DATE", ext: str = ".csv") -> DataFrame:
    """File name without the ``<sub_entity>_`` prefix and the extension (every occurrence)."""
    name = F.replace(F.replace(_c(file_col), F.lit(f"{sub_entity}_"), F.lit("")), F.lit(ext), F.lit(""))
    return df.withColumn(col, name)


def convert_dates(df: DataFrame, cols: Sequence[str], fmt: str = "yyyy.MM.dd") -> DataFrame:
    """Parse text columns as dates; text that does not parse becomes null."""
    return df.withColumns({c: F.try_to_date(F.col(c), fmt) for c in cols})


def date_failures(before: DataFrame, cols: Sequence[str], fmt: str = "yyyy.MM.dd") -> Column:
    """Aggregate: values present but not parseable, summed over ``cols``."""
    total = F.lit(0)
    for c in cols:
        total = total + F.count_if(F.col(c).isNotNull() & F.try_to_date(F.col(c), fmt).isNull())
    return total


def stamp_load_time(df: DataFrame, col: str = "UpdateTimestamp", *, run_ts: str | None = None,
                    tz: str | None = None, fmt: str | None = None) -> DataFrame:
    """Load time column. ``run_ts`` (UTC text) fixes the time (tests, reruns); else
    ``current_timestamp()``. ``tz`` gives wall time in that zone; ``fmt`` makes text."""
    ts = F.lit(run_ts).cast("timestamp_ntz") if run_ts else F.current_timestamp().cast("timestamp_ntz")
    if tz:
        ts = F.convert_timezone(F.lit("UTC"), F.lit(tz), ts)
    if fmt:
        ts = F.date_format(ts, fmt)
    return df.withColumn(col, ts)


def schema_diff(df: DataFrame, expected: StructType, *, types: bool = True) -> list[str]:
    """Differences between the output schema and the declared one."""
    got = {f.name: f.dataType for f in df.schema.fields}
    want = {f.name: f.dataType for f in expected.fields}
    out = [f"missing column {c}" for c in want if c not in got]
    out += [f"unexpected column {c}" for c in got if c not in want]
    if types:
        out += [f"column {c}: {got[c].simpleString()} instead of {want[c].simpleString()}"
                for c in want if c in got and got[c] != want[c]]
    return out


def check_schema(df: DataFrame, expected: StructType | None, action: str = "warn",
                 cast: bool = False) -> DataFrame:
    """``ignore`` / ``warn`` / ``fail`` on a mismatch; ``cast`` aligns types by name."""
    if expected is None:
        return df
    if cast:
        df = df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) if f.name in df.columns
                         else F.lit(None).cast(f.dataType).alias(f.name) for f in expected.fields])
    diff = schema_diff(df, expected)
    if diff and action == "fail":
        raise ValueError("; ".join(diff))
    if diff and action == "warn":
        warnings.warn("output schema differs from the declared one: " + "; ".join(diff), stacklevel=2)
    return df
