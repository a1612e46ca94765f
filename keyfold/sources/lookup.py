"""Delimited lookup files: header lines skipped per file, columns picked, and
'pairs per row' layouts turned into (key, value) rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def lookup_load(spark: SparkSession, path: str, *, sep: str = ";", header_lines: int = 0,
                cols: Sequence[int] | None = None, names: Sequence[str] | None = None) -> DataFrame:
    """Read delimited lookup files, dropping the first ``header_lines`` lines of every
    file (the CSV reader ignores ``skipRows``). ``cols`` picks 0-based fields; the
    result columns are ``names`` or ``c0, c1, ...``.

    Lines are read by the text source, split across tasks like any file. A file's
    first block is never split and its lines arrive in order, so the header lines
    are dropped inside each task (``mapInPandas``) by counting lines per file in
    blocks that start at byte 0: no shuffle, no whole-file rows."""
    lines = spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("_f"), F.col("_metadata.file_block_start").alias("_b"))
    if header_lines:
        lines = lines.mapInPandas(_drop_first_lines(header_lines), lines.schema)
    lines = lines.select(F.col("value").alias("line")).where(F.length("line") > 0)
    fields = F.split(F.col("line"), _regex_escape(sep))
    if cols is None:
        first = lines.select(F.size(fields).alias("n")).agg(F.max("n")).first()[0] or 0
        cols = list(range(first))
    names = list(names) if names else [f"c{i}" for i in range(len(cols))]
    return lines.select(*[F.try_element_at(fields, F.lit(i + 1)).alias(n) for i, n in zip(cols, names)])


def _drop_first_lines(n: int):
    def run(batches):
        seen: dict[str, int] = {}                 # lines met so far per file, in this task
        for pdf in batches:
            at_start = (pdf["_b"] == 0).to_numpy()
            if not at_start.any():
                yield pdf
                continue
            head = pdf[at_start]
            ordinal = head.groupby("_f", sort=False).cumcount().to_numpy() + \
                head["_f"].map(seen).fillna(0).astype("int64").to_numpy()
            for f, c in head["_f"].value_counts(sort=False).items():
                seen[f] = seen.get(f, 0) + int(c)
            keep = ~at_start
            keep[at_start] = ordinal >= n
            yield pdf[keep]
    return run


def _regex_escape(s: str) -> str:
    return "".join("\\" + ch if ch in r"\.^$|?*+()[]{}" else ch for ch in s)


def lookup_unpivot(df: DataFrame, pairs: int, key: str = "key", value: str = "value") -> DataFrame:
    """Columns k0, v0, k1, v1, ... (``pairs`` pairs per row) → rows (key, value),
    by the ``stack`` generator; empty pairs are dropped."""
    cols = df.columns[: 2 * pairs]
    args = ", ".join(f"`{c}`" for c in cols)
    return (df.selectExpr(f"stack({pairs}, {args}) as (`{key}`, `{value}`)")
            .where(F.col(key).isNotNull() & (F.length(key) > 0)))
