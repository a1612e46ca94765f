"""Latest row per key, duplicate keys, duplicate inspection, null-key filters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StringType, StructType

from keyfold.operators.sizing import bounded_broadcast
from keyfold.session import shared_dir

_RN = "__kf_rn"


def sequence_expr(df: DataFrame, seq: str, seq_type: str = "numeric") -> Column:
    """Ordering value of a sequence column.

    ``numeric``: a string sequence is compared as an exact number first ('10' is above
    '9', '1.4' above '1.3'), of any length; text that is not a number is below every number
    and compared as text, so ISO dates and times keep their order. ``string``/``as_is``: the
    column as it is.
    """
    c = F.col(seq)
    if seq_type == "numeric" and isinstance(df.schema[seq].dataType, StringType):
        return _number_order(c)
    return c


def _number_order(c: Column) -> Column:
    """Struct that orders texts of numbers by value: sign, then the length and digits of the
    whole part, then the digits of the fraction. Below zero all of these run backward."""
    # other spellings of a number (1e5) as far as a decimal holds them
    plain = F.when(c.rlike(r"^\s*[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)\s*$"), F.trim(c)).otherwise(c.try_cast("decimal(38,10)").cast("string"))
    whole = F.regexp_extract(plain, r"^[+-]?0*([0-9]*)", 1)
    part = F.regexp_extract(plain, r"[.]([0-9]*?)0*$", 1)
    below = plain.startswith("-")
    sign = F.when(plain.isNull(), F.lit(None)).when((whole == "") & (part == ""), 0).when(below, -1).otherwise(1)
    mirrored = lambda digits: F.translate(digits, "0123456789", "9876543210")
    return F.struct(sign.alias("sign"), F.when(below, -F.length(whole)).otherwise(F.length(whole)).alias("length"),
                    F.when(below, mirrored(whole)).otherwise(whole).alias("whole"),
                    F.when(below, F.concat(mirrored(part), F.lit("~"))).otherwise(part).alias("part"), c.alias("text"))


def _orderable(df: DataFrame, name: str) -> bool:
    return not isinstance(df.schema[name].dataType, (MapType, ArrayType, StructType))


def latest_per_key(df: DataFrame, keys: Sequence[str], seq: str, *, seq_type: str = "numeric",
                   tiebreak: Sequence[str] | None = None, by: Sequence[str] = (),
                   before_seq: Sequence[Column] = ()) -> DataFrame:
    """Keep one row per ``by + keys``: the highest sequence, ties broken by ``tiebreak``
    (default: every other orderable column, so the result is deterministic).

    Planned as ``row_number() = 1``: Spark adds a partial ``WindowGroupLimit`` before
    the shuffle, so a hot key ships at most one row per map partition.
    ``before_seq`` are ordering columns ranked above the sequence (e.g. file order).
    """
    part = [*by, *keys]
    order = [c.desc_nulls_last() for c in before_seq]
    order.append(sequence_expr(df, seq, seq_type).desc_nulls_last())
    rest = tiebreak if tiebreak is not None else [
        c for c in df.columns if c not in part and c != seq and _orderable(df, c)]
    order += [F.col(c).desc_nulls_last() for c in rest]
    w = Window.partitionBy(*part).orderBy(*order)
    return df.withColumn(_RN, F.row_number().over(w)).where(F.col(_RN) == 1).drop(_RN)


def drop_null_keys(df: DataFrame, keys: Sequence[str], how: str = "any") -> DataFrame:
    """``any``: drop rows with a null in some key; ``all``: drop rows whose keys are all null."""
    return df.dropna(how=how, subset=list(keys))


def dup_keys(df: DataFrame, keys: Sequence[str], *, drop_null_keys_first: bool = True,
             count_col: str = "cnt") -> DataFrame:
    """Keys that occur more than once, with their count (partial aggregation before the shuffle)."""
    base = df.select(*keys)
    if drop_null_keys_first:
        base = base.dropna(how="any", subset=list(keys))
    return base.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_col)).where(F.col(count_col) > 1)


def dup_inspect(df: DataFrame, keys: Sequence[str], count_col: str = "cnt") -> DataFrame:
    """All rows whose key is duplicated, with the key's count.

    Written as aggregate-then-join rather than ``count() over (partition by key)``, which
    would load a hot key into one task: the aggregation is combined map-side, and its
    result is written to the checkpoint folder. Within the bounds of ``sizing`` the keys
    are broadcast and ``df`` is not shuffled; beyond them both sides of the join are plain
    shuffles, so AQE splits the partition of a hot key.
    """
    shared_dir(df.sparkSession)
    dups = dup_keys(df, keys, count_col=count_col).checkpoint()
    return df.join(bounded_broadcast(dups), list(keys), "inner")
