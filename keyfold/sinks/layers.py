"""Layers (bronze, silver, quarantine, logs) as catalog tables, and one record of their loads.

A layer that is appended to is partitioned by load, so repeating a load replaces its own rows
only. A keyed layer is partitioned by a hash of its keys; a merge reads and replaces the
touched buckets. Replacement rows are staged outside the table first, and the record of loads
says what a crashed run left to do. One writer at a time."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keyfold.operators import merge as merging
from keyfold.operators import sizing
from keyfold.session import scratch_path, shared_dir
from keyfold.sinks.evolve import create_table, evolve
from keyfold.sources import fs

LOAD, BUCKET = "load_batch", "key_bucket"
IDENT = ["name", "size", "modificationTime"]
LOADS = T.StructType([T.StructField(name, kind) for kind, names in (
    (T.StringType(), ["load_batch", "state", "name"]), (T.LongType(), ["size", "modificationTime"]),
    (T.StringType(), ["action", "staged", "buckets"]), (T.TimestampType(), ["at"])) for name in names])


def new_load() -> str:
    return uuid.uuid4().hex[:16]


@contextmanager
def _by_partition(spark: SparkSession):
    """Overwrites replace the partitions that the new rows hold, not the table."""
    key = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "dynamic")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


class LayerTable:
    """The catalog table ``name``, at ``location`` or in the warehouse. With ``keys`` it is
    keyed: ``buckets`` partitions by key hash, and ``merge`` is possible."""

    def __init__(self, spark: SparkSession, name: str, *, location: str | None = None, keys: Sequence[str] = (), buckets: int = 8):
        self.spark, self.name, self.location = spark, name, location
        self.keys, self.buckets = list(keys), buckets
        self.column = BUCKET if self.keys else LOAD

    def exists(self) -> bool:
        return self.spark.catalog.tableExists(self.name)

    def read(self) -> DataFrame:
        return self.spark.table(self.name).drop(self.column)

    # ---- rows -----------------------------------------------------------------------
    def _bucket(self):
        # over text, so that a whole number hashes alike whatever its width
        return F.pmod(F.xxhash64(*[F.col(f"`{k}`").cast("string") for k in self.keys]), F.lit(self.buckets)).cast("int")

    def _check_keys(self, df: DataFrame) -> None:
        have = dict(self.spark.table(self.name).dtypes)
        whole = {"tinyint", "smallint", "int", "bigint"}
        for k, kind in df.dtypes:
            if k in self.keys and kind != have[k] and not {kind, have[k]} <= whole:
                raise ValueError(f"{self.name}: key {k} is {have[k]}, not {kind}")

    def _laid_out(self, df: DataFrame, load: str) -> DataFrame:
        if not self.keys:
            return df.withColumn(LOAD, F.lit(load))
        # each bucket by as many tasks as its size needs (AQE splits the large ones)
        return df.withColumn(BUCKET, self._bucket()).hint("rebalance", BUCKET)

    def _ensure(self, df: DataFrame) -> None:
        if not self.exists():
            kept = [f for f in df.schema.fields if not isinstance(f.dataType, T.NullType)]
            own = T.StructField(self.column, T.IntegerType() if self.keys else T.StringType())
            create_table(self.spark, self.name, T.StructType([*kept, own]), partition_by=[self.column], location=self.location)

    def _put(self, rows: DataFrame) -> None:
        """Replace the partitions that ``rows`` (laid out) hold."""
        rows = evolve(rows, self.name)
        with _by_partition(self.spark):
            rows.write.mode("overwrite").insertInto(self.name)

    def _drop(self, values: list) -> None:
        """Partitions, with their files: an external table's drop leaves those."""
        place = next(r[1] for r in self.spark.sql(f"DESCRIBE TABLE EXTENDED {self.name}").collect() if r[0] == "Location")
        for v in values:
            text = f"'{v}'" if isinstance(v, str) else v
            self.spark.sql(f"ALTER TABLE {self.name} DROP IF EXISTS PARTITION ({self.column} = {text})")
            fs.delete(self.spark, f"{place}/{self.column}={v}")

    def _held(self) -> list:
        """Partition values: loads or buckets, from the catalog."""
        kind = int if self.keys else str
        return [kind(r[0].split("=", 1)[1]) for r in self.spark.sql(f"SHOW PARTITIONS {self.name}").collect()]

    def held_loads(self) -> list[str]:
        """Loads whose rows the table holds and whose record says done; without a record, all."""
        if self.keys:
            raise ValueError(f"{self.name} is keyed, its rows are not kept by load")
        held = self._held() if self.exists() else []
        if not self.has_loads():
            return held
        open_ = self.loads().groupBy(LOAD).agg(F.bool_or(F.col("state") == "done").alias("done")).where("NOT done")
        unfinished = {r[LOAD] for r in open_.collect()}                    # what crashed runs left: few
        return [x for x in held if x not in unfinished]

    def read_buckets_of(self, df: DataFrame) -> DataFrame:
        """The rows in the buckets that keys of ``df`` fall into; other partitions are not read."""
        touched = [r[0] for r in df.select(self._bucket()).distinct().collect()]
        return self.spark.table(self.name).where(F.col(BUCKET).isin(touched) if touched else F.lit(False)).drop(BUCKET)

    def append(self, df: DataFrame, load: str | None = None) -> None:
        """Add rows. The same ``load`` again replaces its rows."""
        if self.keys:
            raise ValueError(f"{self.name} is keyed: merge into it")
        self._ensure(df)
        self._put(self._laid_out(df, load or new_load()))

    def overwrite(self, df: DataFrame, load: str | None = None) -> None:
        """Replace all rows; ``df`` may read this table."""
        load = load or new_load()
        self._ensure(df)
        staged = self._stage(self._laid_out(df, load))
        rows = self.spark.read.parquet(staged)
        self._put(rows)
        fresh = {r[0] for r in rows.select(self.column).distinct().collect()}
        self._drop([v for v in self._held() if v not in fresh])

    def create_if_absent(self, df: DataFrame, op_col: str | None = None) -> bool:
        """True if the table exists; otherwise create it from ``df`` without deletes."""
        if self.exists():
            return True
        rows = merging.first_load(df, op_col)
        self._ensure(rows)
        self._put(self._laid_out(rows, new_load()))
        return False

    def _stage(self, rows: DataFrame) -> str:
        path = scratch_path(self.spark, "staged")
        rows.write.parquet(path)
        return path

    def merge(self, changes: DataFrame, op_col: str | None = None, *, unmatched_delete: str = "skip",
              load: str | None = None, strategy: str = "auto") -> DataFrame:
        """Apply a change set with one row per key (``merge_ops``; without ``op_col``
        ``merge_upsert``). Returns what became of the rows: (outcome, n), with ``file_name``
        if the changes carry ``merge.FILE``.

        The change set is written to the checkpoint folder once. Only the buckets it touches
        are read, once; the merged buckets are staged, and then replace the old ones."""
        if not self.keys:
            raise ValueError(f"{self.name} has no keys to merge on")
        shared_dir(self.spark)
        changes = merging.one_row_per_key_or_null(changes, self.keys).checkpoint()
        rows = changes.drop(merging.FILE, merging.ACTION)
        self._ensure(rows)
        self._check_keys(rows)
        evolve(rows, self.name)                             # the table's columns first, then its rows
        touched = sorted(r[0] for r in changes.select(self._bucket()).distinct().collect())     # at most ``buckets``
        target = self.spark.table(self.name).where(F.col(BUCKET).isin(touched) if touched else F.lit(False)).drop(BUCKET)
        small = strategy != "shuffle" and sizing.within(changes, merging.BROADCAST_MAX_ROWS, merging.BROADCAST_MAX_BYTES)
        staged = scratch_path(self.spark, "staged")
        if small:
            merging.matched_outcomes(target, changes, self.keys, op_col).write.parquet(staged)
            met = self.spark.read.parquet(staged).where(F.col(merging.OUTCOME) != "kept").select(*self.keys).distinct()
            alone = merging.unmatched_outcomes(changes, met, self.keys, op_col, unmatched_delete)
            merging.align(alone, self.spark.read.parquet(staged).schema).write.mode("append").parquet(staged)
        else:
            merging.outcomes(target, changes, self.keys, op_col, unmatched_delete).write.parquet(staged)
        if load:
            self.record([(load, "staged", staged, ",".join(map(str, touched)))])
        self.apply(staged, touched)
        by = ["outcome", *(["file_name"] if merging.FILE in changes.columns else [])]
        done = self.spark.read.parquet(staged).withColumnRenamed(merging.OUTCOME, "outcome")
        if merging.FILE in changes.columns:
            done = done.withColumnRenamed(merging.FILE, "file_name")
        return done.groupBy(*by).agg(F.count(F.lit(1)).alias("n"))

    def apply(self, staged: str, touched: list[int]) -> None:
        """Put staged buckets in place; may be repeated."""
        rows = self.spark.read.parquet(staged)
        rows = rows.where(~F.col(merging.OUTCOME).isin("deleted", "skipped")).drop(merging.OUTCOME, merging.FILE)
        left = {r[0] for r in rows.select(self._bucket()).distinct().collect()}
        self._put(self._laid_out(rows, ""))
        self._drop([b for b in touched if b not in left])

    # ---- loads ----------------------------------------------------------------------
    @property
    def loads_name(self) -> str:
        return f"{self.name}_loads"

    def has_loads(self) -> bool:
        return self.spark.catalog.tableExists(self.loads_name)

    def loads(self) -> DataFrame:
        """The record of loads: a row per load, state and file."""
        if not self.has_loads():
            return self.spark.createDataFrame([], LOADS)
        return self.spark.table(self.loads_name)

    def _note(self, rows: DataFrame) -> None:
        if not self.has_loads():
            create_table(self.spark, self.loads_name, LOADS, location=f"{self.location}_loads" if self.location else None)
        have = rows.columns
        rows.select(*[(F.current_timestamp() if f.name == "at" else F.col(f.name) if f.name in have else F.lit(None))
                      .cast(f.dataType).alias(f.name) for f in LOADS.fields]).coalesce(1).write.insertInto(self.loads_name)

    def record(self, rows: list[tuple]) -> None:
        """(load, state, staged folder, buckets) of a step of a load."""
        self._note(self.spark.createDataFrame(rows, "load_batch string, state string, staged string, buckets string"))

    def plan(self, load: str, files: DataFrame) -> None:
        """Note the files (name, size, modificationTime, action) of a load before its rows are written."""
        self._note(files.withColumns({LOAD: F.lit(load), "state": F.lit("planned")}))

    def finish(self, load: str, files: DataFrame) -> None:
        """The load's rows are in place: its files are done."""
        self._note(files.withColumns({LOAD: F.lit(load), "state": F.lit("done")}))

    def done_files(self) -> DataFrame:
        """(name, size, modificationTime, action) of files whose rows the table holds, or that were rejected."""
        return self.loads().where("state = 'done'").select(*IDENT, "action").distinct()

    def has_load(self, load: str) -> bool:
        return not self.loads().where((F.col(LOAD) == load) & (F.col("state") == "done")).isEmpty()

    def recover(self) -> None:
        """Settle what crashed runs left: staged buckets are put in place and their load
        finished; a load that was only planned loses the rows it may have written, so that its
        files are loaded anew. At most a few loads, found by one aggregation."""
        if not self.has_loads():
            return
        state = self.loads().groupBy(LOAD).agg(
            F.bool_or(F.col("state").isin("done", "dropped")).alias("over"), F.max("staged").alias("staged"), F.max("buckets").alias("buckets"))
        for r in state.where("NOT over").collect():
            if r["staged"] is not None:
                self.apply(r["staged"], [int(b) for b in (r["buckets"] or "").split(",") if b])
                mine = self.loads().where((F.col(LOAD) == r[LOAD]) & (F.col("state") == "planned"))
                self.finish(r[LOAD], mine.select(*IDENT, "action").checkpoint())
            else:
                if not self.keys and self.exists():
                    self._drop([r[LOAD]])
                self.record([(r[LOAD], "dropped", None, None)])
