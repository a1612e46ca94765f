"""Landing → bronze → silver as single DataFrame plans over all files.

raw_to_bronze: list → select → one CSV read of all chosen files into the shared folder →
quality verdicts for every file in one pass → policy → rows of accepted files →
hook → latest row per (file, key) → null keys dropped → write → route → log.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from keyfold.functions.labels import bytes_label
from keyfold.functions.transforms import check_schema
from keyfold.operators import merge as merge_mod
from keyfold.operators import quality as dq
from keyfold.operators.dedupe import drop_null_keys, latest_per_key, sequence_expr
from keyfold.operators.sizing import bounded_broadcast
from keyfold.plans.steplog import StepLog
from keyfold.session import scratch_path, shared_dir
from keyfold.sinks.layers import IDENT, LOAD, LayerTable, new_load
from keyfold.sinks.routing import move_files, route_files
from keyfold.sources.delimited import delimited_read
from keyfold.sources.listing import file_listing, file_select, is_compressed, read_errors


@dataclass
class BronzeResult:
    verdicts: DataFrame | None = None
    manifest: DataFrame | None = None
    log: DataFrame | None = None
    load: str | None = None
    files: int = 0


def bronze_rows(raw: DataFrame, verdicts: DataFrame, keys: Sequence[str], seq: str | None, *,
                file_col: str = "file_name", hook: Callable | None = None, hook_args: Sequence = (),
                hook_kwargs: dict | None = None, bronze_schema: StructType | None = None,
                schema_action: str = "warn", keep_file_col: bool = False,
                n_files: int | None = None) -> DataFrame:
    """Rows of accepted files, hooked, reduced to the latest per (file, key), null keys out."""
    rows = dq.verdict_join(raw, verdicts, file_col, n_files=n_files)
    rows = drop_null_keys(rows, keys, "any")
    if hook is not None:
        rows = hook(rows, F.col(file_col), *hook_args, **(hook_kwargs or {}))
        rows = check_schema(rows, _with(bronze_schema, file_col), schema_action)
    if seq is not None:
        rows = latest_per_key(rows, keys, seq, by=[file_col])
    return rows if keep_file_col else rows.drop(file_col)


def _with(schema: StructType | None, col: str) -> StructType | None:
    if schema is None or col in schema.names:
        return schema
    from pyspark.sql.types import StringType, StructField
    return StructType([*schema.fields, StructField(col, StringType())])


def strict_read(raw_schema: StructType, read_options: dict | None) -> tuple[StructType, dict, bool]:
    """Schema and options of a read that a bad file cannot end, and whether malformed records
    are findings (``mode=FAILFAST``): they are then kept in a column and the file rejected."""
    options = {"ignoreCorruptFiles": "true", **(read_options or {})}
    strict = str(options.get("mode", "")).upper() == "FAILFAST"
    if strict:
        options |= {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": dq.CORRUPT}
    return (_with(raw_schema, dq.CORRUPT) if strict else raw_schema), options, strict


def per_file(files: DataFrame, n_files: int) -> DataFrame:
    """A side with a row per file, names of at most 1,024 bytes: broadcast up to 100,000 files."""
    return bounded_broadcast(files, known_rows=n_files, max_rows=100_000, max_bytes=None)


@dataclass
class Load:
    """What one load does with its files, for the batch run and for the stream."""
    bronze: LayerTable
    keys: Sequence[str]
    seq: str | None = None
    op_col: str | None = None
    write_mode: str = "append"
    fatal: Sequence[str] = dq.DEFAULT_FATAL
    non_fatal: Sequence[str] = dq.DEFAULT_NON_FATAL
    strict: bool = False
    hook: Callable | None = None
    hook_args: Sequence = ()
    hook_kwargs: dict | None = None
    bronze_schema: StructType | None = None
    quarantine: LayerTable | None = None

    def __post_init__(self):
        if self.hook is not None and self.bronze_schema is None:
            raise ValueError("bronze_schema is required with bronze_func")
        if self.write_mode not in ("append", "overwrite", "merge"):
            raise ValueError(f"unknown write_mode {self.write_mode!r}")

    def judge(self, rows: DataFrame, files: DataFrame) -> DataFrame:
        """A verdict and an action per file (file_name, size, modificationTime, unreadable),
        in landing order: modification time, then name. Written to the checkpoint folder."""
        verdicts = dq.dq_check(rows, self.keys, self.seq, listing=files, with_keys=True)
        if self.strict:
            verdicts = dq.mark_malformed(verdicts, rows)
        verdicts = dq.mark_unreadable(verdicts, F.col("unreadable")).checkpoint()
        # a read error rejects its file, unless it is to stop the run
        non_fatal = self.non_fatal if dq.READ_ERROR in self.fatal else [*self.non_fatal, dq.READ_ERROR]
        return dq.dq_policy(verdicts, fatal=self.fatal, non_fatal=non_fatal, order=["modificationTime", "file_name"])

    def write(self, rows: DataFrame, verdicts: DataFrame, load: str, n_files: int) -> tuple[DataFrame | None, dict]:
        """Rejected rows to the quarantine, accepted ones to bronze, the files on record before
        and after. Returns per file what became of its rows (file_name, outcome, n) in merge
        mode, and the number of files per action."""
        rows = rows.drop(dq.CORRUPT)
        landed = verdicts.where(F.col("action") != "skip").select(
            F.col("file_name").alias("name"), "size", "modificationTime", "action")
        counts = {r["action"]: r["n"] for r in verdicts.groupBy("action").agg(F.count(F.lit(1)).alias("n")).collect()}
        self.bronze.plan(load, landed)
        if self.quarantine is not None and counts.get("reject", 0) + counts.get("stop", 0):
            self._hold_back(rows, verdicts, landed, load, n_files)
        done = None
        if counts.get("accept"):                # else the table stays as it is
            done = self._to_bronze(rows, verdicts, load, n_files)
        self.bronze.finish(load, landed)
        return done, counts

    def _hold_back(self, rows, verdicts, landed, load, n_files) -> None:
        """Rows of the rejected files that no earlier run held back, each file once."""
        bad = landed.where(F.col("action").isin("reject", "stop")).join(self.quarantine.done_files().select(*IDENT), IDENT, "left_anti")
        bad = bad.checkpoint()
        if bad.isEmpty():
            return
        fresh = verdicts.join(bad.select(F.col("name").alias("file_name")), "file_name", "left_semi")
        self.quarantine.recover()
        self.quarantine.plan(load, bad)
        self.quarantine.append(dq.rejected_rows(rows, fresh, n_files=n_files), load)
        self.quarantine.finish(load, bad)

    def _to_bronze(self, rows, verdicts, load, n_files) -> DataFrame | None:
        rows = bronze_rows(rows, verdicts, self.keys, self.seq, hook=self.hook, hook_args=self.hook_args, hook_kwargs=self.hook_kwargs,
                           bronze_schema=self.bronze_schema, keep_file_col=True, n_files=n_files)
        if self.write_mode == "append":
            self.bronze.append(rows.drop("file_name"), load)
            return None
        landing_order = [F.col("modificationTime"), F.col("file_name")]
        if self.write_mode == "overwrite":
            last = verdicts.where(F.col("action") == "accept").orderBy(*[c.desc() for c in landing_order]).limit(1)
            rows = rows.join(F.broadcast(last.select("file_name")), "file_name", "left_semi")   # one row
            self.bronze.overwrite(rows.drop("file_name"), load)
            return None
        times = per_file(verdicts.select("file_name", "modificationTime"), n_files)
        ordered = rows.join(times, "file_name")
        if self.op_col:
            # exact equivalent of merging the files one after another (see fold_changes)
            order = [*landing_order, *([sequence_expr(ordered, self.seq).asc_nulls_first()] if self.seq else [])]
            changes, merge_op = merge_mod.fold_changes(ordered, self.keys, self.op_col, order), merge_mod.ACTION
        else:                                   # upserts: the last file's row wins
            changes = latest_per_key(ordered, self.keys, self.seq or "file_name", before_seq=landing_order)
            merge_op = None
        changes = changes.drop("modificationTime").withColumnRenamed("file_name", merge_mod.FILE)
        return self.bronze.merge(changes, merge_op, load=load)

    def file_counts(self, verdicts: DataFrame, merged: DataFrame | None) -> DataFrame:
        """Per file what was read, rejected and, by outcome, written; files without that
        activity have nulls. A merge counts a key at the file whose row decided."""
        taken, out = F.col("action") == "accept", F.col("action").isin("reject", "stop")
        files = verdicts.select(
            F.col("file_name").alias("name"), "size", "action", F.when(F.col("action") != "skip", F.col("n_rows")).alias("n_read"),
            F.when(out, F.col("n_rows")).when(taken, F.lit(0)).alias("n_rejected"),
            F.when(taken, F.col("n_keys" if self.seq else "n_keyed_rows")).alias("n_inserted"))
        if merged is None:
            return files.withColumns({c: F.when(taken, F.lit(0)) for c in ("n_updated", "n_deleted", "n_left")}).drop("action")
        by_file = merged.where("file_name IS NOT NULL").groupBy(F.col("file_name").alias("of")).pivot(
            "outcome", ["inserted", "updated", "deleted", "left"]).agg(F.sum("n"))
        joined = files.drop("n_inserted").join(by_file, F.col("name") == F.col("of"), "left")
        return joined.select("name", "size", "n_read", "n_rejected", *[
            F.when(taken, F.coalesce(F.col(c), F.lit(0))).alias(f"n_{c}") for c in ("inserted", "updated", "deleted", "left")])


def probed(spark: SparkSession, files: DataFrame, packed: int) -> DataFrame:
    """The files as ``judge`` takes them; ``packed``: how many are compressed, so are opened."""
    if packed:
        bad = read_errors(spark, files).select("name", F.lit(True).alias("unreadable"))
        files = files.join(bad, "name", "left").fillna(False, ["unreadable"]).checkpoint()
    else:
        files = files.withColumn("unreadable", F.lit(False))
    return files.withColumnRenamed("name", "file_name")


def stop_if_fatal(verdicts: DataFrame) -> None:
    stop = verdicts.where(F.col("action") == "stop").select("file_name", "code").first()
    if stop is not None:
        raise dq.DataQualityError(stop["file_name"], stop["code"])


def raw_to_bronze(spark: SparkSession, landing: str, raw_schema: StructType, bronze: LayerTable,
                  keys: Sequence[str], *, seq: str | None = None, op_col: str | None = None,
                  write_mode: str = "append", process_file: str = "multiple",
                  file_name: str | None = None, fatal: Sequence[str] = dq.DEFAULT_FATAL,
                  non_fatal: Sequence[str] = dq.DEFAULT_NON_FATAL, delimiter: str = "|",
                  header: bool = True, read_options: dict | None = None,
                  bronze_func: Callable | None = None, f_args: Sequence = (), f_kwargs: dict | None = None,
                  bronze_schema: StructType | None = None, archive_dir: str | None = None,
                  error_dir: str | None = None, move: bool = False, pattern: str = "*",
                  quarantine: LayerTable | None = None, log_table: LayerTable | None = None,
                  batch_id: str | None = None) -> BronzeResult:
    """All landed files into bronze, in one plan.

    The files are parsed once, into the shared folder; checks and writes read that. The list
    of files stays a DataFrame: the landing folder is read as a whole, and rows of files that
    the listing does not have wait for the next run.

    A file fails alone: a compressed file that cannot be read to its end gets the verdict
    ``ReadError`` and is rejected, and with ``read_options={"mode": "FAILFAST"}`` so does one
    with a malformed record, unless that verdict is in ``fatal``.

    Files that bronze holds already, by name, size and modification time, are only moved.
    What a crashed run left is settled first (``LayerTable.recover``). Rows of rejected files
    go to ``quarantine`` before bronze is written, each file once."""
    read_schema, options, strict = strict_read(raw_schema, read_options)
    job = Load(bronze, keys, seq, op_col, write_mode, fatal, non_fatal, strict, bronze_func, f_args, f_kwargs, bronze_schema, quarantine)
    shared_dir(spark)
    log = StepLog()
    base = landing.rstrip("/")
    archive, error = archive_dir or f"{base}/archive", error_dir or f"{base}/error"
    log.start("read")
    listed = file_select(file_listing(spark, landing, pattern), process_file, file_name)
    if bronze.has_loads():
        bronze.recover()
        listed = listed.checkpoint()
        done = bronze.done_files()
        if move:
            seen = listed.join(done, IDENT).withColumnRenamed("name", "file_name")
            move_files(spark, route_files(seen, archive, error))
        listed = listed.join(done.select(*IDENT), IDENT, "left_anti")
    fresh = listed.checkpoint()
    sizes = fresh.agg(F.count(F.lit(1)).alias("n"), F.count_if(is_compressed(F.col("name"))).alias("packed")).first()
    res = BronzeResult(files=sizes["n"])
    if not res.files:
        return res
    where = landing if process_file == "multiple" else fresh.first()["path"]
    parsed = delimited_read(spark, where, read_schema, delimiter=delimiter, header=header,
                            **{"pathGlobFilter": pattern, **options})
    known = per_file(fresh.select(F.col("name").alias("file_name")), res.files)
    folder = scratch_path(spark, "parsed")
    parsed.join(known, "file_name", "left_semi").write.parquet(folder)
    rows = spark.read.schema(parsed.schema).parquet(folder)
    files = probed(spark, fresh, sizes["packed"])
    log.end("read")

    log.start("data_quality")
    verdicts = res.verdicts = job.judge(rows, files)
    log.end("data_quality")

    log.start("write")
    merged, counts = None, {"stop": 1}
    if batch_id is None or not bronze.has_load(batch_id):
        res.load = batch_id or new_load()
        merged, counts = job.write(rows, verdicts, res.load, res.files)
    log.end("write")

    log.start("archive")
    res.manifest = route_files(verdicts, archive, error).withColumn("size_label", bytes_label(F.col("size")))
    if move:
        move_files(spark, res.manifest)
    log.end("archive")

    res.log = log.frame(job.file_counts(verdicts, merged))
    if log_table is not None:
        log_table.append(res.log)
    if counts.get("stop"):
        stop_if_fatal(verdicts)
    return res


def bronze_to_silver(spark: SparkSession, bronze: LayerTable, silver: LayerTable,
                     keys: Sequence[str], *, seq: str | None = None, op_col: str | None = None,
                     write_mode: str = "merge", silver_func: Callable | None = None,
                     f_args: Sequence = (), f_kwargs: dict | None = None,
                     silver_schema: StructType | None = None, schema_action: str = "warn",
                     unmatched_delete: str = "skip") -> None:
    """Whole bronze → latest per key → hook → create, or merge / overwrite / append. A silver
    that is merged into is keyed by ``keys``."""
    if write_mode not in ("merge", "overwrite", "append"):
        raise ValueError(f"unknown write_mode {write_mode!r}")
    df = bronze.read()
    if seq is not None:
        df = latest_per_key(df, keys, seq)
    if silver_func is not None:
        df = silver_func(df, *f_args, **(f_kwargs or {}))
        df = check_schema(df, silver_schema, schema_action)
    if not silver.create_if_absent(df, op_col):
        return
    if write_mode == "merge":
        # the change set is all of bronze reduced per key: as large as silver, so the
        # merge is a shuffle join and no size check is needed
        silver.merge(df, op_col, unmatched_delete=unmatched_delete, strategy="shuffle")
    elif write_mode == "overwrite":
        silver.overwrite(df)
    else:
        silver.append(df)


def new_bronze_to_silver(spark: SparkSession, bronze: LayerTable, silver: LayerTable, keys: Sequence[str], *,
                         seq: str, op_col: str | None = None, silver_func: Callable | None = None,
                         f_args: Sequence = (), f_kwargs: dict | None = None,
                         silver_schema: StructType | None = None, schema_action: str = "warn") -> int:
    """``bronze_to_silver`` in merge mode that reads only the loads of bronze (appended to)
    that silver has not seen; returns their number.

    Beside silver, ``<silver>_latest`` keeps each key's latest bronze row, deletes too: its
    high-water mark. A new row counts if it stands above its key's mark by the order of
    ``latest_per_key``; late rows and lower sequences do not, and a row above a delete brings
    its key back. Applying a key's latest row again changes nothing, so the result equals
    reading all of bronze again. Of the marks, only the buckets of the new keys are read.
    Loads are noted as seen last; after a crash they are applied again."""
    marks = LayerTable(spark, f"{silver.name}_latest", keys=keys, buckets=silver.buckets,
                       location=f"{silver.location}_latest" if silver.location else None)
    seen = {r[LOAD] for r in silver.loads().where("state = 'seen'").select(LOAD).distinct().collect()} if silver.has_loads() else set()
    loads = [x for x in bronze.held_loads() if x not in seen]              # one name per run of the ingest
    if not loads:
        return 0
    shared_dir(spark)
    rows = spark.table(bronze.name).where(F.col(LOAD).isin(loads)).drop(LOAD)
    fresh = latest_per_key(drop_null_keys(rows, keys), keys, seq).checkpoint()
    changes = fresh
    if marks.exists():
        rest = [c for c in fresh.columns if c not in (*keys, seq)]
        old = marks.read_buckets_of(fresh).join(fresh.select(*keys), list(keys), "left_semi")
        both = fresh.withColumn("__kf_new", F.lit(1)).unionByName(old.withColumn("__kf_new", F.lit(0)), allowMissingColumns=True)
        changes = latest_per_key(both, keys, seq, tiebreak=[*rest, "__kf_new"]).where("__kf_new = 1").drop("__kf_new").checkpoint()
    df = changes
    if silver_func is not None:
        df = check_schema(silver_func(df, *f_args, **(f_kwargs or {})), silver_schema, schema_action)
    if silver.create_if_absent(df, op_col):
        silver.merge(df, op_col)
    marks.merge(changes)
    silver.record([(x, "seen", None, None) for x in loads])
    return len(loads)


def raw_to_silver(spark: SparkSession, spec, landing: str, bronze: LayerTable,
                  silver: LayerTable, *, bronze_mode: str = "append", silver_mode: str = "merge",
                  **bronze_kw) -> BronzeResult:
    """Both steps for an ``EntitySpec``: its schemas, keys, columns and hooks."""
    res = raw_to_bronze(spark, landing, spec.raw_schema, bronze, list(spec.primary_keys),
                        seq=spec.sequence_column, op_col=spec.operation_column, write_mode=bronze_mode,
                        delimiter=spec.delimiter, header=spec.header, read_options=spec.read_options,
                        bronze_func=spec.bronze_func, f_args=spec.bronze_args,
                        f_kwargs=spec.bronze_kwargs, bronze_schema=spec.bronze_schema, **bronze_kw)
    if res.files == 0 or not bronze.exists():
        return res
    bronze_to_silver(spark, bronze, silver, list(spec.primary_keys), seq=spec.sequence_column,
                     op_col=spec.operation_column, write_mode=silver_mode,
                     silver_func=spec.silver_func, f_args=spec.silver_args,
                     f_kwargs=spec.silver_kwargs, silver_schema=spec.silver_schema)
    return res
