"""Derived inputs for the registered queries, built by Spark from the given tables:
the change feed over orders, pseudo-files over lineitem, landing files of events,
people from part and towns from nation. Each has a DuckDB twin in ``workloads``."""

from __future__ import annotations

import time
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keyfold.sources import fs

TS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
CSV_OPTIONS = {"timestampNTZFormat": TS_FORMAT, "timestampFormat": TS_FORMAT}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# ---- change feed over orders ------------------------------------------------------
def orders_cdc(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    op = (F.when(F.col("o_orderkey") % 5 == 1, F.lit("U"))
          .when(F.col("o_orderstatus") == "F", F.lit("D"))
          .when(F.col("o_orderstatus") == "O", F.lit("I")))
    return o.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
                    "o_orderpriority", op.alias("op"))


def cdc_target(spark, sf_dir) -> DataFrame:
    return orders_cdc(spark, sf_dir).where(F.col("o_orderkey") % 10 != 0)


def cdc_target_repeated(spark, sf_dir) -> DataFrame:
    """The target with every key divisible by 7 twice, as an appended bronze table holds it."""
    t = cdc_target(spark, sf_dir)
    return t.unionByName(t.where(F.col("o_orderkey") % 7 == 0).withColumn("o_totalprice", F.col("o_totalprice") + 7))


def in_source() -> Column:
    """Orders in the change set: with the target's rows, every order has a part."""
    return (F.col("o_orderkey") % 3 == 0) | (F.col("o_orderkey") % 10 == 0)


def cdc_source(spark, sf_dir) -> DataFrame:
    return (orders_cdc(spark, sf_dir).where(in_source())
            .withColumn("o_totalprice", F.col("o_totalprice") + 100))


# ---- pseudo-files over lineitem ---------------------------------------------------
def lineitem_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    f = F.col("l_orderkey") % 20
    both_null = (f == 3) & (F.col("l_linenumber") == 1)
    return li.select(
        F.when(both_null, F.lit(None)).otherwise(F.col("l_orderkey")).alias("l_orderkey"),
        "l_partkey", "l_suppkey",
        F.when(both_null | (f == 4), F.lit(None)).otherwise(F.col("l_linenumber")).alias("l_linenumber"),
        "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus",
        "l_shipdate", F.concat(F.lit("part_"), f.cast("string")).alias("file_name"))


def lineitem_listing(spark: SparkSession) -> DataFrame:
    """Expected pseudo-files part_0 … part_20; part_20 has no rows."""
    return spark.range(21).select(F.concat(F.lit("part_"), F.col("id").cast("string")).alias("file_name"))


# ---- landing files ------------------------------------------------------------------
def write_named_files(spark: SparkSession, df: DataFrame, name: Column, folder: str, *,
                      delimiter: str = "|", header: bool = True, options: dict | None = None) -> list[str]:
    """One delimited file per distinct ``name`` value, placed at ``folder/<name>``.
    Each value is written by one task; the part files are then renamed."""
    tmp = f"{folder.rstrip('/')}/_staging"
    (df.withColumn("__kf_name", name).repartition("__kf_name").write.partitionBy("__kf_name")
       .options(delimiter=delimiter, header=header, **(options or {})).csv(tmp))
    out = []
    for d in fs.list_dirs(spark, tmp):
        seg = d.rstrip("/").rsplit("/", 1)[-1]
        if "=" not in seg:
            continue
        value = unquote(seg.split("=", 1)[1])   # Spark %-escapes partition values
        parts = [f for f in fs.list_files(spark, d) if f.rsplit("/", 1)[-1].startswith("part-")]
        for i, part in enumerate(parts):
            target = f"{folder.rstrip('/')}/{value}" if len(parts) == 1 else f"{folder.rstrip('/')}/{i}_{value}"
            fs.rename(spark, part, target)
            out.append(target)
    fs.delete(spark, tmp)
    # the files "land" in name order: parallel tasks finish in any order, so the
    # modification times (which define file order) are stamped one second apart
    start = (int(time.time()) - len(out)) * 1000
    for i, f in enumerate(sorted(out)):
        fs.set_mtime(spark, f, start + i * 1000)
    return sorted(out)


def events_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    op = (F.when(F.col("event_type") == "error", F.lit("D"))
          .when(F.col("event_type") == "signup", F.lit("I"))
          .when(F.col("event_type") == "click", F.lit("U")))
    return e.withColumn("op", op)


def events_file_index(ts: Column) -> Column:
    return F.least(F.floor((F.dayofmonth(ts) - 1) / 6), F.lit(4)).cast("int")   # day 31: last file


def events_file_name(ts: Column) -> Column:
    k = events_file_index(ts)
    return F.concat(F.lit("events_2024.01."), F.lpad((k * 6 + 1).cast("string"), 2, "0"), F.lit(".csv"))


EVENTS_RAW_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()), T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()), T.StructField("props", T.StringType()),
    T.StructField("op", T.StringType()),
])


def events_parts(spark: SparkSession, sf_dir: str, rows_per_file: int = 500_000) -> int:
    """Landing files of a period of events."""
    return -(-table(spark, sf_dir, "events").count() // (5 * rows_per_file)) or 1


def events_landing(spark: SparkSession, sf_dir: str, folder: str, files: tuple[int, ...] = (0, 1, 2, 3, 4),
                   rows_per_file: int = 500_000) -> str:
    """Events as landing files of six days each, dealt by user into parts, so many that no
    part holds more than about ``rows_per_file`` rows; each is written by one task. The
    first part of a period has the plain name."""
    events, parts = events_raw(spark, sf_dir), events_parts(spark, sf_dir, rows_per_file)
    part = F.pmod(F.xxhash64("user_id"), F.lit(parts))
    plain = events_file_name(F.col("ts"))
    name = F.when(part == 0, plain).otherwise(F.concat(F.replace(plain, F.lit(".csv"), F.lit("_p")), part.cast("string"), F.lit(".csv")))
    df = events.where(events_file_index(F.col("ts")).isin(*files))
    write_named_files(spark, df, name, folder, options=CSV_OPTIONS)
    return folder


# ---- people and towns -----------------------------------------------------------------
def town_code(nationkey: Column) -> Column:
    return F.concat(F.lit("A"), F.lpad(nationkey.cast("string"), 3, "0"))


def people(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    k = F.col("p_partkey")
    parts = F.split(F.col("p_name"), " ")
    town = F.when(k % 50 == 7, F.lit("atlantis")).otherwise(F.lower(F.col("n_name")))
    return (p.withColumn("__nk", (k % 25).cast("int"))
            .join(n, F.col("__nk") == F.col("n_nationkey"), "inner")
            .select("p_partkey",
                    F.get(parts, 0).alias("surname"), F.get(parts, 1).alias("name"),
                    (F.lit(1940) + k % 70).cast("string").alias("year"),
                    (k % 12 + 1).cast("string").alias("month"),
                    (k % 28 + 1).cast("string").alias("day"),
                    F.when(k % 2 == 0, F.lit("M")).otherwise(F.lit("f")).alias("gender"),
                    town.alias("town")))


def towns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Towns of the lookup files: one per nation (the people's towns) and one per
    supplier, so that the lookup grows with the data. Columns code, region, name, idx."""
    n = table(spark, sf_dir, "nation").select(
        town_code(F.col("n_nationkey")).alias("code"), F.col("n_regionkey").cast("string").alias("region"),
        F.col("n_name").alias("name"), F.col("n_nationkey").cast("long").alias("idx"))
    s = table(spark, sf_dir, "supplier").select(
        F.concat(F.lit("S"), F.lpad(F.col("s_suppkey").cast("string"), 7, "0")).alias("code"),
        F.lit("0").alias("region"), F.col("s_name").alias("name"),
        (F.col("s_suppkey") + 25).cast("long").alias("idx"))
    return n.unionByName(s)


def _write_with_headers(body: DataFrame, headers: list[str], files: int, path: str) -> str:
    """Text files ``bucket=0 .. files-1`` below ``path``; each starts with the header
    lines, then its rows in ``o`` order. ``body`` has columns bucket, o, value."""
    spark = body.sparkSession
    head = spark.createDataFrame([(b, i - len(headers), h) for b in range(files) for i, h in enumerate(headers)],
                                 "bucket int, o long, value string")
    (head.unionByName(body).repartition(files, "bucket").sortWithinPartitions("bucket", "o")
     .select("bucket", "value").write.partitionBy("bucket").text(path))
    return path


def write_town_file(spark: SparkSession, sf_dir: str, path: str) -> str:
    """Towns as ';' files (four), each with two header lines: code;region;name."""
    t = towns(spark, sf_dir)
    body = t.select((F.col("idx") % 4).cast("int").alias("bucket"), F.col("idx").alias("o"),
                    F.concat_ws(";", "code", "region", "name").alias("value"))
    return _write_with_headers(body, ["# towns", "code;region;name"], 4, path)


def write_wide_town_file(spark: SparkSession, sf_dir: str, path: str) -> str:
    """Towns as tab files (three), each with one header line and four (name, code)
    pairs per row."""
    t = towns(spark, sf_dir)
    slots = t.select((F.col("idx") / 4).cast("long").alias("r"), (F.col("idx") % 4).alias("slot"),
                     F.concat_ws("\t", "name", "code").alias("pair"))
    rows = (slots.groupBy("r").pivot("slot", [0, 1, 2, 3]).agg(F.first("pair"))
            .select((F.col("r") % 3).cast("int").alias("bucket"), F.col("r").alias("o"),
                    F.concat_ws("\t", *[F.coalesce(F.col(str(i)), F.lit("\t")) for i in range(4)]).alias("value")))
    return _write_with_headers(rows, ["#Town\tCode\tTown\tCode\tTown\tCode\tTown\tCode"], 3, path)
