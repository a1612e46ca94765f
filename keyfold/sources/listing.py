"""File listings as DataFrames, and file selection before the read."""

from __future__ import annotations

import bz2
import zlib
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from keyfold.sources import fs

#: Bytes decompressed at once when a file is probed.
BLOCK = 1 << 16


def file_listing(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """Files (not folders) directly in ``folder`` whose names match ``pattern`` (default:
    all but hidden ones, which begin with ``_`` or ``.``): path, name, size,
    modificationTime (epoch milliseconds). File contents are never read: ``content`` is
    pruned. A folder without such files gives no rows."""
    source = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder)
    rows = source.select(F.col("path"),
                         F.element_at(F.split(F.col("path"), "/"), -1).alias("name"),
                         F.col("length").alias("size"),
                         F.unix_millis(F.col("modificationTime")).alias("modificationTime"))
    indexed = source.inputFiles()
    if len(indexed) == rows.count():
        return rows
    # Spark scans no files of zero bytes: they are in the source's index only
    names = spark.createDataFrame([(unquote(f.rsplit("/", 1)[-1]),) for f in indexed], "name string")
    empty = [r["name"] for r in names.join(rows, "name", "left_anti").collect()]
    times = [(f"{folder.rstrip('/')}/{n}", n, 0, fs.mtime(spark, f"{folder.rstrip('/')}/{n}")) for n in empty]
    return rows.unionByName(spark.createDataFrame(times, rows.schema))


def is_compressed(name: Column) -> Column:
    """Whether a file name has a suffix of the codecs that ``read_errors`` opens."""
    return F.regexp_like(name, F.lit(f"(?i)[.]({'|'.join(_CODECS)})$"))


def read_errors(spark: SparkSession, listing: DataFrame) -> DataFrame:
    """(name, error) of compressed files of ``listing`` that cannot be decompressed to their
    end. Each is opened in a task and decompressed block by block; files that are not
    compressed are not opened. Known by suffix: gz, deflate, bz2, zst."""
    paths = listing.where(is_compressed(F.col("name"))).select("path", "name")
    chosen = [r["path"] for r in paths.select(F.regexp_replace("path", r"[^/]*$", "").alias("path")).distinct().collect()]  # folders
    if not chosen:
        return listing.sparkSession.createDataFrame([], "name string, error string")
    # a file whose content cannot even be fetched gives no row here
    content = spark.read.format("binaryFile").option("ignoreCorruptFiles", "true").load(chosen).select("path", "content")
    opened = paths.select("path").join(content, "path").mapInArrow(_open_files, "path string, error string")
    return (paths.join(opened, "path", "left").where(F.coalesce(F.col("error") != "", F.lit(True)))
            .select("name", F.coalesce("error", F.lit("cannot be read")).alias("error")))


def _zstd():
    import zstandard
    return zstandard.ZstdDecompressor().decompressobj()


_CODECS = {"gz": lambda: zlib.decompressobj(31), "deflate": zlib.decompressobj, "bz2": bz2.BZ2Decompressor, "zst": _zstd}


def _open_files(batches):
    """(path, error) of each (path, content): an empty error if the content decompresses to its
    end. Output is dropped block by block; a file may hold several compressed members."""
    for batch in batches:
        for path, content in zip(batch.column(0).to_pylist(), batch.column(1)):
            data, error = memoryview(content.as_buffer()), ""
            make = _CODECS[path.rsplit(".", 1)[-1].lower()]
            try:
                unpack, at = make(), 0
                while at < len(data):
                    if unpack.eof:
                        unpack = make()
                    block = data[at:at + BLOCK]
                    unpack.decompress(block)
                    at += len(block) - len(unpack.unused_data)
                if len(data) and not unpack.eof:
                    error = "ends too early"
            except Exception as e:          # any fault of the file is its finding
                error = str(e) or type(e).__name__
            yield pa.RecordBatch.from_pydict({"path": [path], "error": [error]})


def file_select(listing: DataFrame, process_file: str = "multiple",
                file_name: str | None = None) -> DataFrame:
    """``multiple``: all files; ``single``: the file named ``file_name``;
    ``last``: the most recent (modification time, then name)."""
    if process_file == "multiple":
        return listing
    if process_file == "single":
        if file_name is None:
            raise ValueError("file_name is required when process_file='single'")
        return listing.where(F.col("name") == F.lit(file_name))
    if process_file == "last":
        return listing.orderBy(F.desc("modificationTime"), F.desc("name")).limit(1)
    raise ValueError(f"unknown process_file {process_file!r}")
