"""Schema evolution of catalog tables: added columns and widened types."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Decimal digits of the whole-number types.
_WHOLE = {"tinyint": 3, "smallint": 5, "int": 10, "bigint": 19}


def wider(a: T.DataType, b: T.DataType) -> T.DataType | None:
    """The least type that holds every value of both, or None if there is none. Parquet files
    of either are read as it, so a table can be widened without rewriting them."""
    if a == b:
        return a
    x, y = a.simpleString(), b.simpleString()
    if x in _WHOLE and y in _WHOLE:
        return a if _WHOLE[x] > _WHOLE[y] else b
    if {x, y} == {"date", "timestamp_ntz"}:
        return T.TimestampNTZType()
    if {x, y} == {"float", "double"}:
        return T.DoubleType()
    for one, other in ((a, b), (b, a)):
        if other.simpleString() == "double" and one.simpleString() in ("tinyint", "smallint", "int"):
            return other
    if all(isinstance(t, T.DecimalType) or t.simpleString() in _WHOLE for t in (a, b)):
        scale = max(t.scale if isinstance(t, T.DecimalType) else 0 for t in (a, b))
        whole = max(t.precision - t.scale if isinstance(t, T.DecimalType) else _WHOLE[t.simpleString()] for t in (a, b))
        # long files are read as a decimal only without fraction digits
        if whole + scale <= 38 and not (scale and "bigint" in (x, y)):
            return T.DecimalType(max(whole + scale, 20 if {x, y} & set(_WHOLE) else 1), scale)
    return None


def columns_ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def partition_columns(spark: SparkSession, table: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(table) if c.isPartition]


def create_table(spark: SparkSession, table: str, schema: T.StructType, *, partition_by=(), location: str | None = None,
                 fmt: str = "parquet") -> None:
    parts = f" PARTITIONED BY ({', '.join(f'`{c}`' for c in partition_by)})" if partition_by else ""
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE {table} ({columns_ddl(schema)}) USING {fmt}{parts}{place}")


def evolve(df: DataFrame, table: str) -> DataFrame:
    """Make ``table`` ready for the rows of ``df`` and return them in its columns.

    Columns that the table lacks are added (older rows read them as null); a type that does
    not hold the new values is widened to one that holds both. Types without such a common
    type (text and numbers, bigint and double) raise before anything is changed. Columns that
    ``df`` lacks become null."""
    spark = df.sparkSession
    have = {f.name: f.dataType for f in spark.table(table).schema.fields}
    added, widened, clashes = [], {}, []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.NullType):
            continue
        if f.name not in have:
            added.append(T.StructField(f.name, f.dataType))
        elif f.dataType != have[f.name]:
            common = wider(have[f.name], f.dataType)
            if common is None:
                clashes.append(f"{f.name}: {have[f.name].simpleString()} and {f.dataType.simpleString()}")
            elif common != have[f.name]:
                widened[f.name] = common
    if clashes:
        raise ValueError(f"{table} cannot hold the new rows, no type holds both of {'; '.join(clashes)}")
    if widened and set(widened) & set(partition_columns(spark, table)):
        raise ValueError(f"{table}: the type of a partition column cannot change: {', '.join(widened)}")
    if added:
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({columns_ddl(T.StructType(added))})")
    if widened:
        _widen(spark, table, widened)
    return df.select(*[(F.col(f"`{f.name}`") if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
                       for f in spark.table(table).schema.fields])


def _widen(spark: SparkSession, table: str, types: dict[str, T.DataType]) -> None:
    """Declare columns of ``table`` with wider types. The files of an external table stay as
    they are: it is declared again over them. A managed table is copied, as dropping its old
    declaration drops its files."""
    info = {r[0]: r[1] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()}
    parts = partition_columns(spark, table)
    schema = T.StructType([T.StructField(f.name, types.get(f.name, f.dataType)) for f in spark.table(table).schema.fields])
    fmt = info["Provider"].lower()
    if info["Type"] == "EXTERNAL":
        spark.sql(f"DROP TABLE {table}")
        create_table(spark, table, schema, partition_by=parts, location=info["Location"], fmt=fmt)
        if parts:
            spark.catalog.recoverPartitions(table)
        return
    copy = f"{table}_wide_{uuid.uuid4().hex[:8]}"
    writer = spark.table(table).select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema.fields]).write.format(fmt)
    (writer.partitionBy(*parts) if parts else writer).saveAsTable(copy)
    spark.sql(f"DROP TABLE {table}")
    spark.sql(f"ALTER TABLE {copy} RENAME TO {table}")
