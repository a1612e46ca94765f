"""Table scans by catalog name or by path."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table_scan(spark: SparkSession, name_or_path: str, fmt: str = "parquet",
               merge_schema: bool = False) -> DataFrame:
    """A path (contains ``/``) is read with ``fmt``; otherwise a catalog table."""
    if "/" in name_or_path:
        r = spark.read.format(fmt)
        if merge_schema:
            r = r.option("mergeSchema", "true")
        return r.load(name_or_path)
    return spark.read.table(name_or_path)
