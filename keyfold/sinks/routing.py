"""Where each landing file goes after its verdict: a manifest, and the moves."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from itertools import islice

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keyfold.sources import fs


def route_files(verdicts: DataFrame, archive_dir: str, error_dir: str,
                name_col: str = "file_name") -> DataFrame:
    """Manifest: accepted files to ``archive_dir``, rejected or stopping files to
    ``error_dir``, skipped files stay (null destination)."""
    a, e = archive_dir.rstrip("/") + "/", error_dir.rstrip("/") + "/"
    dest = (F.when(F.col("action") == "accept", F.concat(F.lit(a), F.col(name_col)))
            .when(F.col("action").isin("reject", "stop"), F.concat(F.lit(e), F.col(name_col))))
    return verdicts.withColumn("destination", dest)


def move_files(spark: SparkSession, manifest: DataFrame, path_col: str = "path", *,
               threads: int = 16, chunk: int = 1000) -> int:
    """Carry out the moves of a manifest. Renames are metadata calls (no content
    moves) issued from the driver by ``threads`` workers, as object stores answer
    each call with a round trip; the manifest streams in, ``chunk`` rows at a time,
    and each destination folder is created once."""
    rows = (manifest.where(F.col("destination").isNotNull())
            .select(F.col(path_col).alias("src"), F.col("destination").alias("dst"))
            .toLocalIterator(prefetchPartitions=True))
    made: set[str] = set()
    n = 0
    with ThreadPoolExecutor(max_workers=threads) as pool:
        while batch := [(r["src"], r["dst"]) for r in islice(rows, chunk)]:
            for parent in {d.rsplit("/", 1)[0] for _, d in batch} - made:
                fs.mkdirs(spark, parent)
                made.add(parent)
            for _ in pool.map(lambda p: fs.rename(spark, p[0], p[1], make_parent=False), batch):
                n += 1
    return n
