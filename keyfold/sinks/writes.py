"""Writes: append, overwrite, schema evolution, and the code register."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keyfold.sinks.evolve import evolve


def _write(df: DataFrame, target: str, mode: str, fmt: str, location: str | None) -> None:
    writer = df.write.mode(mode).format(fmt)
    if "/" in target:
        writer.save(target)
    elif location:
        writer.option("path", location).saveAsTable(target)
    else:
        writer.saveAsTable(target)


def append_write(df: DataFrame, target: str, fmt: str = "parquet", *, location: str | None = None) -> None:
    """Append to a path (contains ``/``) or to a catalog table, which is created if absent:
    at ``location``, or in the warehouse. An existing table gains the columns it lacks, and
    types that do not hold the new values are widened (``evolve``)."""
    if "/" not in target and df.sparkSession.catalog.tableExists(target):
        evolve(df, target).write.insertInto(target)
    else:
        _write(df, target, "append", fmt, location)


def overwrite_write(df: DataFrame, target: str, fmt: str = "parquet", *, location: str | None = None) -> None:
    """Replace a folder or a catalog table. Never point this at what the plan reads."""
    _write(df, target, "overwrite", fmt, location)


def read_evolved(spark: SparkSession, path: str) -> DataFrame:
    """Union of all column sets written over time (Parquet ``mergeSchema``)."""
    return spark.read.option("mergeSchema", "true").parquet(path)


def code_register_write(df: DataFrame, path: str, *, sep: str = ";") -> None:
    """Append rows upper-cased to a delimited register with a header."""
    up = df.select(*[F.upper(F.col(c).cast("string")).alias(c) for c in df.columns])
    up.write.mode("append").option("sep", sep).option("header", True).csv(path)
