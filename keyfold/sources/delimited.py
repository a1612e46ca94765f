"""Delimited landing files, read by Spark's CSV source."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def file_name() -> Column:
    """Name of a row's source file as the listing has it: Spark's metadata gives it
    URL-encoded, in which a plus sign stands for itself."""
    return F.url_decode(F.replace(F.col("_metadata.file_name"), F.lit("+"), F.lit("%2B")))


def delimited_read(spark: SparkSession, paths: str | Sequence[str], schema: StructType, *,
                   delimiter: str = "|", header: bool = True, file_col: str | None = "file_name",
                   file_meta: bool = False, **options) -> DataFrame:
    """Read with a declared schema (no inference); any reader option passes through.
    ``file_col`` keeps the source file name so one plan can serve many files."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    df = (spark.read.options(delimiter=delimiter, header=header, **options)
          .schema(schema).csv(paths))
    if file_col:
        df = df.withColumn(file_col, file_name())
    if file_meta:
        df = df.withColumns({"file_path": F.col("_metadata.file_path"),
                             "file_size": F.col("_metadata.file_size"),
                             "file_modified": F.col("_metadata.file_modification_time")})
    return df


def delimited_read_untyped(spark: SparkSession, paths: str | Sequence[str], *,
                           delimiter: str = ";", header: bool = True, **options) -> DataFrame:
    """Read with a header and no schema: every column is a string."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    return spark.read.options(delimiter=delimiter, header=header, inferSchema=False, **options).csv(paths)
