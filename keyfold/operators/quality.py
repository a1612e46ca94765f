"""Data-quality verdicts per file in one pass over the input, and the policy that
turns a verdict into an action."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keyfold.operators.sizing import bounded_broadcast

# Verdict codes and severities (00 stop flow, 10 stop step, 20 warn, 30 info).
EMPTY = "EmptyError"
KEYS_NULL = "KeysNull"
DUPLICATED = "DuplicatedFound"
DUP_NEWER_SEQUENCE = "DuplicatedKeyNewerSequence"
READ_ERROR = "ReadError"
SEVERITY = {READ_ERROR: "10", EMPTY: "10", KEYS_NULL: "10", DUPLICATED: "10", DUP_NEWER_SEQUENCE: "20"}

# Default policy: no fatal verdict; empty files and true duplicates reject the file.
DEFAULT_FATAL: tuple[str, ...] = ()
DEFAULT_NON_FATAL: tuple[str, ...] = (EMPTY, DUPLICATED)

#: Column that keeps a malformed record's text in a strict read.
CORRUPT = "__kf_corrupt"


class DataQualityError(Exception):
    def __init__(self, file_name: str, code: str):
        super().__init__(f"{file_name}: {code}")
        self.file_name, self.code, self.severity = file_name, code, SEVERITY.get(code)


def _all_null(keys: Sequence[str]) -> Column:
    c = F.lit(True)
    for k in keys:
        c = c & F.col(k).isNull()
    return c


def _any_null(keys: Sequence[str]) -> Column:
    c = F.lit(False)
    for k in keys:
        c = c | F.col(k).isNull()
    return c


def quality_counters(df: DataFrame, keys: Sequence[str], seq: str | None,
                     file_col: str = "file_name", *, with_keys: bool = False) -> DataFrame:
    """Per file: rows, rows with all keys null, duplicated keys, duplicated (key, sequence).
    ``with_keys`` adds the whole keys (n_keys) and their rows (n_keyed_rows).

    Three nested aggregations over one read of (file, keys, seq): each level is
    combined map-side, so a hot key is reduced before every shuffle.
    """
    keys = list(keys)
    lvl1_cols = [file_col, *keys] + ([seq] if seq else [])
    l1 = df.select(*lvl1_cols).groupBy(*lvl1_cols).agg(F.count(F.lit(1)).alias("_c"))
    seq_dup = (F.col(seq).isNotNull() & (F.col("_c") > 1)) if seq else (F.col("_c") > 1)
    l2 = l1.groupBy(file_col, *keys).agg(
        F.sum("_c").alias("_n"),
        F.count_if(seq_dup).alias("_seq_dups"))
    keyed = F.when(~_any_null(keys), F.col("_n"))
    more = [F.count(keyed).alias("n_keys"), F.coalesce(F.sum(keyed), F.lit(0)).cast("long").alias("n_keyed_rows")] if with_keys else []
    return l2.groupBy(file_col).agg(
        *more, F.sum("_n").cast("long").alias("n_rows"),
        F.sum(F.when(_all_null(keys), F.col("_n")).otherwise(0)).cast("long").alias("n_all_null_keys"),
        F.count_if(~_any_null(keys) & (F.col("_n") > 1)).cast("long").alias("n_dup_keys"),
        F.sum(F.when(~_any_null(keys), F.col("_seq_dups")).otherwise(0)).cast("long").alias("n_dup_key_seq"))


def verdict_expr() -> Column:
    """First failing check wins: empty, all keys null, duplicates, duplicates with newer sequence."""
    return (F.when(F.coalesce(F.col("n_rows"), F.lit(0)) == 0, F.lit(EMPTY))
            .when(F.col("n_all_null_keys") > 0, F.lit(KEYS_NULL))
            .when(F.col("n_dup_key_seq") > 0, F.lit(DUPLICATED))
            .when(F.col("n_dup_keys") > 0, F.lit(DUP_NEWER_SEQUENCE)))


def _severity(code: Column) -> Column:
    m = F.create_map(*[x for k, v in SEVERITY.items() for x in (F.lit(k), F.lit(v))])
    return F.try_element_at(m, code)


def dq_check(df: DataFrame, keys: Sequence[str], seq: str | None = None, *,
             file_col: str = "file_name", listing: DataFrame | None = None, with_keys: bool = False) -> DataFrame:
    """One verdict row per file. ``listing`` (one row per file, column ``file_col``)
    brings in files without rows, which no ``groupBy`` can see.

    Without a sequence column a repeated key is a ``DuplicatedFound``.
    """
    counters = quality_counters(df, keys, seq, file_col, with_keys=with_keys)
    if listing is not None:
        counters = listing.join(counters, file_col, "left").fillna(
            0, [c for c in counters.columns if c.startswith("n_")])
    code = verdict_expr()
    return counters.withColumn("code", code).withColumn("severity", _severity(F.col("code")))


def mark_malformed(verdicts: DataFrame, df: DataFrame, file_col: str = "file_name") -> DataFrame:
    """``verdicts`` with ``ReadError`` for every file of ``df`` that holds a malformed record
    (``CORRUPT`` is set). One pass, combined map-side to a row per file. ``df`` must be parsed
    rows: a CSV scan converts only the columns that a query needs and misses bad values."""
    bad = df.where(F.col(CORRUPT).isNotNull()).groupBy(file_col).agg(F.count(F.lit(1)).alias("n_malformed"))
    return mark_unreadable(verdicts.join(bad, file_col, "left").fillna(0, ["n_malformed"]), F.col("n_malformed") > 0)


def mark_unreadable(verdicts: DataFrame, which: Column) -> DataFrame:
    """``verdicts`` with ``ReadError`` where ``which`` holds, before any other finding."""
    return (verdicts.withColumn("code", F.when(which, F.lit(READ_ERROR)).otherwise(F.col("code")))
            .withColumn("severity", _severity(F.col("code"))))


def dq_empty(df: DataFrame, listing: DataFrame, file_col: str = "file_name") -> DataFrame:
    """Files of the listing without any row."""
    return listing.join(df.select(file_col).distinct(), file_col, "left_anti")


def dq_null_keys(df: DataFrame, keys: Sequence[str], file_col: str = "file_name") -> DataFrame:
    """Files with rows whose keys are all null, and how many."""
    return (df.groupBy(file_col).agg(F.count_if(_all_null(keys)).cast("long").alias("n_all_null_keys"))
            .where(F.col("n_all_null_keys") > 0))


def dq_duplicates(df: DataFrame, keys: Sequence[str], seq: str | None,
                  file_col: str = "file_name") -> DataFrame:
    """Files where a key repeats with the same sequence (severity 10)."""
    return (quality_counters(df, keys, seq, file_col).where(F.col("n_dup_key_seq") > 0)
            .select(file_col, "n_dup_keys", "n_dup_key_seq"))


def dq_dup_sequence(df: DataFrame, keys: Sequence[str], seq: str,
                    file_col: str = "file_name") -> DataFrame:
    """Files where a key repeats only with different sequences (severity 20)."""
    return (quality_counters(df, keys, seq, file_col)
            .where((F.col("n_dup_keys") > 0) & (F.col("n_dup_key_seq") == 0))
            .select(file_col, "n_dup_keys", "n_dup_key_seq"))


def dq_policy(verdicts: DataFrame, *, fatal: Sequence[str] = DEFAULT_FATAL,
              non_fatal: Sequence[str] = DEFAULT_NON_FATAL,
              order: Sequence[Column | str] = ("file_name",)) -> DataFrame:
    """Verdict → action: ``stop`` (fatal; file rejected and the run ends), ``reject``
    (file to the error folder, run goes on), ``accept``; files ordered after the
    first fatal one are ``skip`` (left untouched).

    The first fatal file is found by a scalar subquery (a distributed ``min`` of the
    file order over the stopping files); each file is then compared with it. No
    window without a partition, so the verdict table never passes through one task.
    """
    code = F.col("code")
    raw = (F.when(code.isin(*fatal) if fatal else F.lit(False), F.lit("stop"))
           .when(code.isin(*non_fatal) if non_fatal else F.lit(False), F.lit("reject"))
           .otherwise(F.lit("accept")))
    with_raw = verdicts.withColumn("_raw_action", raw)
    if not fatal:
        return with_raw.withColumnRenamed("_raw_action", "action")
    key = F.struct(*[F.col(c) if isinstance(c, str) else c for c in order])
    first_stop = with_raw.where(F.col("_raw_action") == "stop").select(F.min(key)).scalar()
    after_stop = F.coalesce(key > first_stop, F.lit(False))
    return (with_raw.withColumn("action", F.when(after_stop, F.lit("skip")).otherwise(F.col("_raw_action")))
            .drop("_raw_action"))


def verdict_join(rows: DataFrame, verdicts: DataFrame, file_col: str = "file_name",
                 accept: Sequence[str] = ("accept",), *, n_files: int | None = None) -> DataFrame:
    """Rows of accepted files. The verdict table has one row per file: it is broadcast
    when the file count (``n_files`` if the caller knows it, else measured) is within
    the bound, otherwise the semi join is shuffled."""
    ok = verdicts.where(F.col("action").isin(*accept)).select(file_col)
    return rows.join(bounded_broadcast(ok, known_rows=n_files), file_col, "left_semi")


def rejected_rows(rows: DataFrame, verdicts: DataFrame, file_col: str = "file_name", *,
                  n_files: int | None = None) -> DataFrame:
    """Rows of rejected or stopping files, with their verdict (quarantine sink)."""
    bad = verdicts.where(F.col("action").isin("reject", "stop")).select(file_col, "code", "severity")
    return rows.join(bounded_broadcast(bad, known_rows=n_files), file_col, "inner")
