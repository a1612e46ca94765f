"""Incremental landing → bronze with Structured Streaming's file source.

Every micro-batch holds whole files, so the per-file checks hold inside ``foreachBatch``. The
checkpoint says which micro-batches were processed; bronze has the record of the files it
holds, so a replayed batch goes on with the files that no load decided: after a crash, or
after a fatal verdict, those behind the fatal file.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from keyfold.operators import quality as dq
from keyfold.plans.ingest import Load, per_file, probed, stop_if_fatal, strict_read
from keyfold.plans.steplog import StepLog
from keyfold.session import scratch_path, shared_dir
from keyfold.sinks.layers import IDENT, LayerTable, new_load
from keyfold.sinks.routing import move_files, route_files
from keyfold.sources.delimited import delimited_read, file_name
from keyfold.sources.listing import file_listing, is_compressed


@dataclass
class FileStream:
    """Landed files into bronze, batch by batch. ``write_mode`` is ``append`` (each
    micro-batch's accepted rows) or ``merge`` (its files folded in landing order and merged
    as one change set, the same result as merging them one after another).

    Rejected files go to ``error_dir`` once their verdict is on record. Accepted ones go to
    ``archive_dir``: with ``clean_source="archive"`` by Spark's file source, which moves the
    files of a batch when a later one starts, so ``settle`` moves the last ones; with
    ``move`` at once; else they stay."""
    spark: SparkSession
    landing: str
    raw_schema: StructType
    bronze: LayerTable
    keys: Sequence[str]
    checkpoint: str
    seq: str | None = None
    op_col: str | None = None
    write_mode: str = "append"
    delimiter: str = "|"
    header: bool = True
    pattern: str = "*"
    read_options: dict | None = None
    max_files: int | None = None
    fatal: Sequence[str] = dq.DEFAULT_FATAL
    non_fatal: Sequence[str] = dq.DEFAULT_NON_FATAL
    bronze_func: object = None
    f_args: Sequence = ()
    f_kwargs: dict | None = None
    bronze_schema: StructType | None = None
    quarantine: LayerTable | None = None
    log_table: LayerTable | None = None
    verdict_table: LayerTable | None = None
    clean_source: str | None = None
    move: bool = False
    archive_dir: str | None = None
    error_dir: str | None = None
    available_now: bool = True
    job: Load = field(init=False)

    def __post_init__(self):
        if self.write_mode not in ("append", "merge"):
            raise ValueError(f"unknown write_mode {self.write_mode!r}")
        base = self.landing.rstrip("/")
        self.archive_dir, self.error_dir = self.archive_dir or f"{base}/archive", self.error_dir or f"{base}/error"
        self.schema, self.options, strict = strict_read(self.raw_schema, self.read_options)
        self.job = Load(self.bronze, self.keys, self.seq, self.op_col, self.write_mode, self.fatal, self.non_fatal, strict,
                        self.bronze_func, self.f_args, self.f_kwargs, self.bronze_schema, self.quarantine)
        shared_dir(self.spark)

    def start(self):
        """The running query; with ``available_now`` it processes what has landed and stops."""
        reader = (self.spark.readStream.schema(self.schema).option("delimiter", self.delimiter).option("header", self.header)
                  .options(**self.options).option("pathGlobFilter", self.pattern))
        if self.max_files:
            reader = reader.option("maxFilesPerTrigger", self.max_files)
        if self.clean_source:
            reader = reader.option("cleanSource", self.clean_source)
            if self.clean_source == "archive":
                reader = reader.option("sourceArchiveDir", self.archive_dir)
        # the file name must be selected before foreachBatch
        stream = reader.csv(self.landing).withColumn("file_name", file_name())
        w = stream.writeStream.foreachBatch(self._batch).option("checkpointLocation", self.checkpoint)
        w = w.trigger(availableNow=True) if self.available_now else w.trigger(processingTime="1 minute")
        return w.start()

    def run(self) -> None:
        """Process what has landed, then ``settle``."""
        self.start().awaitTermination()
        self.settle()

    def settle(self) -> None:
        """After the last batch: files without rows that no batch has judged get their verdict,
        and files on record that still lie in the landing folder are moved."""
        self._decide(None, None)
        if self.move or self.clean_source == "archive":
            self._move_done()

    def _move_done(self, actions: Sequence[str] = ("accept", "reject", "stop")) -> None:
        listed = file_listing(self.spark, self.landing, self.pattern)
        done = listed.join(self.bronze.done_files().where(F.col("action").isin(*actions)), IDENT)
        move_files(self.spark, route_files(done.withColumnRenamed("name", "file_name"), self.archive_dir, self.error_dir))

    def _batch(self, batch: DataFrame, batch_id: int) -> None:
        # parsed once, into the shared folder; also, the batch's own session ends with it
        folder = scratch_path(self.spark, f"stream-{batch_id}")
        batch.write.parquet(folder)
        self._decide(self.spark.read.schema(batch.schema).parquet(folder), self.max_files)

    def _decide(self, rows: DataFrame | None, limit: int | None) -> None:
        """Judge and write the files of a batch, or with no rows what is left."""
        log = StepLog()
        self.bronze.recover()
        log.start("read")
        listed = file_listing(self.spark, self.landing, self.pattern)
        open_ = listed.join(self.bronze.done_files().select(*IDENT), IDENT, "left_anti").checkpoint()
        mine = open_.where("false")
        if rows is not None:
            mine = open_.join(rows.select(F.col("file_name").alias("name")).distinct(), "name", "left_semi").checkpoint()
        files = mine.unionByName(self._without_rows(open_, mine, limit)).checkpoint()
        sizes = files.agg(F.count(F.lit(1)).alias("n"), F.count_if(is_compressed(F.col("name"))).alias("packed")).first()
        n = sizes["n"]
        if not n:
            return
        known = per_file(files.select(F.col("name").alias("file_name")), n)
        rows = (self._read([]) if rows is None else rows).join(known, "file_name", "left_semi")
        files = probed(self.spark, files, sizes["packed"])
        log.end("read")
        log.start("data_quality")
        verdicts = self.job.judge(rows, files)
        log.end("data_quality")
        log.start("write")
        load = new_load()
        merged, counts = self.job.write(rows, verdicts, load, n)
        log.end("write")
        log.start("archive")
        if self.move or (self.clean_source == "archive" and (counts.get("reject") or counts.get("stop"))):
            self._move_done(("reject", "stop", "accept") if self.move else ("reject", "stop"))
        log.end("archive")
        if self.verdict_table is not None:
            self.verdict_table.append(verdicts.where(F.col("action") != "skip"), load)
        if self.log_table is not None:
            self.log_table.append(log.frame(self.job.file_counts(verdicts, merged)), load)
        if counts.get("stop"):
            stop_if_fatal(verdicts)

    def _read(self, paths: list[str]) -> DataFrame:
        if not paths:
            return self.spark.createDataFrame([], self.schema).withColumn("file_name", F.lit(""))
        return delimited_read(self.spark, paths, self.schema, delimiter=self.delimiter, header=self.header, **self.options)

    def _without_rows(self, open_: DataFrame, mine: DataFrame, limit: int | None) -> DataFrame:
        """Files that the batch holds but that have no rows, which no DataFrame of its rows
        shows: those that landed before the batch's last file; in a batch without rows, the
        first ``limit`` files. The source takes files in landing order. Each is opened to
        make sure; there are few."""
        order = F.struct("modificationTime", "name")
        others = open_.join(mine.select("name"), "name", "left_anti")
        last = mine.agg(F.max(order).alias("last")).first()["last"]
        if last is not None:
            found = others.where(order < F.struct(F.lit(last["modificationTime"]).cast("long"), F.lit(last["name"])))
        else:
            found = others.orderBy("modificationTime", "name").limit(limit) if limit else others
        found = found.checkpoint()
        paths = [r["path"] for r in found.select("path").collect()]
        if not paths:
            return found
        full = self._read(paths).select(F.col("file_name").alias("name")).distinct()
        return found.join(full, "name", "left_anti")


def stream_raw_to_bronze(spark: SparkSession, landing: str, raw_schema: StructType, bronze: LayerTable,
                         keys: Sequence[str], checkpoint: str, **options):
    """Start a ``FileStream`` with its options and return the query."""
    return FileStream(spark, landing, raw_schema, bronze, keys, checkpoint, **options).start()
