"""Versions of a table: a partition per version and a table of commits, and what one version
has lost against another."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from keyfold.operators.sizing import bounded_broadcast
from keyfold.session import shared_dir
from keyfold.sinks.evolve import create_table, evolve

VERSION = "version"


def save_version(df: DataFrame, table: str, operation: str, *, append: bool = False, location: str | None = None) -> int:
    """Write ``df`` as the next version of the catalog table ``table``, with ``append`` after
    the rows of the one before. A version is a partition; ``<table>_commits`` has its row
    count. One writer at a time; a version counts once its commit is written."""
    spark = df.sparkSession
    commits = f"{table}_commits"
    last = spark.table(commits).agg(F.max(VERSION)).first()[0] if spark.catalog.tableExists(commits) else None
    version = (last or 0) + 1
    rows = read_version(spark, table, last).unionByName(df, allowMissingColumns=True) if append and last else df
    seen = Observation(f"version_{version}")
    _add(rows.observe(seen, F.count(F.lit(1)).alias("n")).withColumn(VERSION, F.lit(version).cast("long")), table, location, [VERSION])
    note = spark.createDataFrame([(version, operation, seen.get["n"])], "version long, operation string, num_rows long")
    _add(note.withColumn("committed_at", F.current_timestamp()).coalesce(1), commits, f"{location}_commits" if location else None, [])
    return version


def _add(df: DataFrame, table: str, location: str | None, parts: list[str]) -> None:
    if not df.sparkSession.catalog.tableExists(table):
        create_table(df.sparkSession, table, df.schema, partition_by=parts, location=location)
    evolve(df, table).write.insertInto(table)


def read_version(spark: SparkSession, table: str, version: int) -> DataFrame:
    """The table as of a version: one partition is read."""
    return spark.table(table).where(F.col(VERSION) == version).drop(VERSION)


def history(spark: SparkSession, table: str) -> DataFrame:
    """The commits, newest first."""
    return spark.table(f"{table}_commits").orderBy(F.desc(VERSION))


def snapshot_deleted(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of the old version whose key is gone in the new one (an anti join;
    Catalyst does not turn ``left join … where new.k is null`` into one)."""
    any_null = F.lit(False)
    for k in keys:
        any_null = any_null | F.col(k).isNull()
    # null keys never match, so those rows are gone by definition and skip the join.
    # The new version's keys are de-duplicated (combined map-side) and written to the
    # checkpoint folder: broadcast within the bounds of ``sizing``, beyond them both sides
    # of the join are plain shuffles, so AQE splits the partition of a hot key.
    shared_dir(new.sparkSession)
    kept = new.select(*keys).where(~any_null).distinct().checkpoint()
    return (old.where(~any_null).join(bounded_broadcast(kept), list(keys), "left_anti")
            .unionByName(old.where(any_null)))
