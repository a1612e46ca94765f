"""Step log (activity, file, size, start, end, row counts) and the timing report over it."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keyfold.functions.labels import duration_seconds, time_label

LOG_SCHEMA = T.StructType([
    T.StructField("activity", T.StringType(), False),
    T.StructField("file_name", T.StringType(), False),
    T.StructField("file_size", T.LongType(), False),
    T.StructField("start_time", T.TimestampType(), False),
    T.StructField("end_time", T.TimestampType(), False),
])
#: Row counts of a file's log rows, each in the row of its activity and null in the others.
COUNTS = {"n_read": "read", "n_rejected": "data_quality", "n_inserted": "write", "n_updated": "write", "n_deleted": "write",
          "n_left": "write"}


def _now() -> _dt.datetime:
    return _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)


class StepLog:
    """Driver-side timings of the plan's activities (read, data_quality, write,
    archive). Each activity runs once for all files, so every file of the run gets
    one row per activity carrying that activity's interval."""

    def __init__(self):
        self.steps: list[tuple[str, _dt.datetime, _dt.datetime]] = []
        self._open: dict[str, _dt.datetime] = {}

    def start(self, activity: str) -> None:
        self._open[activity] = _now()

    def end(self, activity: str) -> None:
        self.steps.append((activity, self._open.pop(activity), _now()))

    def frame(self, files: DataFrame, name_col: str = "name", size_col: str = "size") -> DataFrame:
        """One row per (file, activity): the file list is exploded, never crossed. Counts
        that ``files`` holds (``COUNTS``) appear in the rows of their activity."""
        acts = F.array(*[F.struct(F.lit(a).alias("activity"),
                                  F.lit(s).cast("timestamp").alias("start_time"),
                                  F.lit(e).cast("timestamp").alias("end_time"))
                         for a, s, e in self.steps]) if self.steps else F.array()
        counts = [c for c in COUNTS if c in files.columns]
        return (files.select(F.col(name_col).alias("file_name"), F.col(size_col).cast("long").alias("file_size"),
                             *counts, F.explode(acts).alias("s"))
                .select("s.activity", "file_name", "file_size", "s.start_time", "s.end_time",
                        *[F.when(F.col("s.activity") == COUNTS[c], F.col(c).cast("long")).alias(c) for c in counts]))


def timing_report(log: DataFrame, by: Sequence[str] = ("activity",), *,
                  duration_col: str | None = None) -> DataFrame:
    """Sum, average and count of durations per group (no group: one row), with
    readable labels. Durations in seconds from ``duration_col`` or end - start."""
    dur = F.col(duration_col) if duration_col else duration_seconds("start_time", "end_time")
    g = log.withColumn("__kf_d", dur)
    aggs = [F.sum("__kf_d").alias("total_duration_s"), F.avg("__kf_d").alias("avg_duration_s"),
            F.count(F.lit(1)).alias("total_files")]
    out = g.groupBy(*by).agg(*aggs) if by else g.agg(*aggs)
    return (out.withColumn("total_duration_s", F.round("total_duration_s", 6))
               .withColumn("avg_duration_s", F.round("avg_duration_s", 6))
               .withColumn("total_duration_time", time_label(F.col("total_duration_s")))
               .withColumn("avg_duration_time", time_label(F.col("avg_duration_s"))))
