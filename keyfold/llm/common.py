"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from keyfold.session import shared_dir

#: A word: a run without the six ASCII white-space characters. ``bytes.split()``
#: cuts at exactly these six, so UTF-8 bytes give the same words.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """``df`` written to the shared checkpoint folder (reliable, so lost executors cost
    nothing) and its lineage cut."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def with_rank(df: DataFrame, name: str, *order: Column) -> DataFrame:
    """``df`` with each row's place (from 0) in the given order: sorted by ranges, then
    counted by partition, so that no task holds all rows. Cuts the lineage."""
    placed = cut(df.repartitionByRange(*order).sortWithinPartitions(*order))
    placed = (placed.withColumn("__kf_part", F.spark_partition_id())
              .withColumn("__kf_low", F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)))
    sizes = {r["__kf_part"]: r["count"] for r in placed.groupBy("__kf_part").count().collect()}
    starts, total = [], 0
    for k in range(max(sizes, default=-1) + 1):
        starts.append(F.lit(total).cast("long"))
        total += sizes.get(k, 0)
    start = F.element_at(F.array(*starts), F.col("__kf_part") + 1) if starts else F.lit(0).cast("long")
    return placed.withColumn(name, start + F.col("__kf_low")).drop("__kf_part", "__kf_low")


def id_and_bytes(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id long, text binary): the only columns an operator reads, so that extra
    columns, clashing names included, cannot interfere."""
    return df.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                     F.col(f"`{text_col}`").cast("string").cast("binary").alias("text"))


def crc_mod(id_col: Column, n: int) -> Column:
    """crc32 of the id written as text, modulo ``n``."""
    return F.pmod(F.crc32(id_col.cast("string").cast("binary")), F.lit(n))


def crc_sql(text: str) -> str:
    """crc32 of an ASCII text expression in DuckDB, which has no such function: bit by bit."""
    mixed = f"(CASE WHEN k % 8 = 0 THEN xor(a, ascii({text}[(k // 8 + 1)::INT])::BIGINT) ELSE a END)"
    return (f"xor(list_reduce(list_prepend(4294967295::BIGINT, range(0, 8 * strlen({text}))), lambda a, k: "
            f"xor({mixed} >> 1, CASE WHEN {mixed} & 1 = 1 THEN 3988292384::BIGINT ELSE 0::BIGINT END)), 4294967295::BIGINT)")


def rows_of(batch: pa.RecordBatch) -> Iterator[tuple]:
    """Rows of a batch one at a time, so only one text is a Python object at once."""
    columns = [batch.column(i) for i in range(batch.num_columns)]
    for k in range(batch.num_rows):
        yield tuple(c[k].as_py() for c in columns)


def map_rows(df: DataFrame, make: Callable[[], Callable[[tuple], list[tuple]]], schema: str,
             per_batch: int = 4096) -> DataFrame:
    """``mapInArrow`` with a row function: ``make()`` is called once per task and gives
    a function from a row to output rows; output batches hold about ``per_batch`` rows."""
    names = [f.name for f in _schema(df.sparkSession, schema)]
    types = _arrow_types(df.sparkSession, schema)

    def run(batches):
        fn, out = make(), []
        for b in batches:
            for row in rows_of(b):
                out.extend(fn(row))
                if len(out) >= per_batch:
                    yield _batch(out, names, types)
                    out = []
        if out:
            yield _batch(out, names, types)

    return df.mapInArrow(run, schema)


def _schema(spark: SparkSession, ddl: str):
    from pyspark.sql.types import StructType
    return StructType.fromDDL(ddl)


def _arrow_types(spark: SparkSession, ddl: str) -> list[pa.DataType]:
    from pyspark.sql.pandas.types import to_arrow_schema
    return list(to_arrow_schema(_schema(spark, ddl)).types)


def _batch(rows: list[tuple], names: list[str], types: list[pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)
