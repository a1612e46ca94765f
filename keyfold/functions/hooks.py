"""Ready-made layer hooks. A bronze hook is called as ``f(df, file_name_col, *args)``
(the file name is a column, so one plan serves every file); a silver hook as
``f(df, *args)``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame

from keyfold.functions import transforms


def source_and_business_date(df: DataFrame, file_name: Column | str, sub_entity: str,
                             source: str) -> DataFrame:
    """Bronze: constant ``SOURCE`` and ``BUSINESS_DATE`` from the file name
    (``<sub_entity>_<date>.csv`` → ``<date>``)."""
    return transforms.business_date_from_file(transforms.add_source(df, source), file_name, sub_entity)


def dates_and_update_time(df: DataFrame, date_cols: Sequence[str], run_ts: str | None = None,
                          fmt: str = "yyyy.MM.dd") -> DataFrame:
    """Silver: parse the date columns and stamp ``UpdateTimestamp``."""
    return transforms.stamp_load_time(transforms.convert_dates(df, date_cols, fmt), "UpdateTimestamp",
                                      run_ts=run_ts)


def source_and_insert_minute(df: DataFrame, source: str, tz: str = "Europe/Rome",
                             run_ts: str | None = None) -> DataFrame:
    """Silver: constant ``SOURCE`` and ``DATE_INSERT``, the load minute as text in ``tz``."""
    return transforms.stamp_load_time(transforms.add_source(df, source), "DATE_INSERT", run_ts=run_ts,
                                      tz=tz, fmt="yyyy-MM-dd HH:mm")
