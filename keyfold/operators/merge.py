"""Applying a change set to a target: upsert with deletes by operation type,
plain upsert, merge on a free condition, and the coalescing merge.

All modes are one full outer join plus a whole-row choice; no per-row Python.
Rows with a null key can never match an equality, so they bypass the join and
are unioned back: a flood of null keys cannot land in one join partition.

A keyed change set must hold one row per key (the pipelines make it so with
``latest_per_key``); a repeated key raises rather than pairing every copy with
the target row, as a lakehouse ``MERGE`` does when several source rows match.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, NullType, StructType

from keyfold.operators import ranges, sizing
from keyfold.session import shared_dir

_T, _S, _N, _ROW = "__kf_t", "__kf_s", "__kf_n", "__kf_row"
DELETE, INSERT = "D", "I"


def _col_or_null(df: DataFrame, alias: str, name: str, dtype) -> Column:
    if name in df.columns:
        return F.col(f"{alias}.{name}")
    return F.lit(None).cast(dtype)


def _out_columns(target: DataFrame, source: DataFrame) -> list[tuple[str, object]]:
    """Target columns first, then columns only the source has (schema evolution)."""
    cols = [(f.name, f.dataType) for f in target.schema.fields]
    seen = {c for c, _ in cols}
    cols += [(f.name, f.dataType) for f in source.schema.fields if f.name not in seen]
    return [(c, t if not isinstance(t, NullType) else source.schema[c].dataType) for c, t in cols]


def _any_null(keys: Sequence[str]) -> Column:
    c = F.lit(False)
    for k in keys:
        c = c | F.col(k).isNull()
    return c


def _align(df: DataFrame, cols: list[tuple[str, object]]) -> DataFrame:
    return df.select(*[(F.col(c) if c in df.columns else F.lit(None).cast(t)).alias(c) for c, t in cols])


def align(df: DataFrame, schema: StructType) -> DataFrame:
    """``df`` in the columns of ``schema``: missing ones null, types cast."""
    return df.select(*[(F.col(f"`{f.name}`") if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
                       for f in schema.fields])


def one_row_per_key(source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``source`` with a check that no key repeats (a repeated key raises).

    An aggregation on the keys: it is combined map-side, so even a key holding a
    third of all rows is reduced before the shuffle, and its output is already
    hash-partitioned on the keys, which the following join on the keys reuses.
    Rows with a null key must have been split off before."""
    keys = list(keys)
    rest = [c for c in source.columns if c not in keys]
    aggs = [F.count(F.lit(1)).alias(_N)]
    if rest:
        aggs.append(F.any_value(F.struct(*[F.col(f"`{c}`") for c in rest])).alias(_ROW))
    agg = source.groupBy(*keys).agg(*aggs)
    msg = F.concat(F.lit("change set holds a key more than once: "), F.to_json(F.struct(*keys)))
    checked = agg.where(F.when(F.col(_N) > 1, F.raise_error(msg)).otherwise(F.lit(True)))
    return checked.select(*[F.col(f"`{c}`") if c in keys else F.col(f"{_ROW}.`{c}`").alias(c)
                            for c in source.columns])


def _merge(target: DataFrame, source: DataFrame, *, keys: Sequence[str], op_col: str | None, unmatched_delete: str,
           coalesce_values: bool, checked: bool = False) -> DataFrame:
    """One full outer join. ``checked``: the source is known to have one row per key."""
    cols = _out_columns(target, source)
    bypass_t = target.where(_any_null(keys))
    bypass_s = source.where(_any_null(keys))
    target = target.where(~_any_null(keys))
    source = source.where(~_any_null(keys))
    source = source if checked else one_row_per_key(source, keys)

    t = target.withColumn(_T, F.lit(True)).alias("target_table")
    s = source.withColumn(_S, F.lit(True)).alias("source_table")
    j = t.join(s, _on(keys), "full_outer")

    has_t = F.col(f"target_table.{_T}").isNotNull()
    has_s = F.col(f"source_table.{_S}").isNotNull()
    op = F.col(f"source_table.{op_col}") if op_col else F.lit(None).cast("string")

    if coalesce_values:
        out = j.select(*[F.coalesce(_col_or_null(source, "source_table", c, dt),
                                    _col_or_null(target, "target_table", c, dt)).alias(c)
                         for c, dt in cols])
        if op_col:
            out = out.where(~F.col(op_col).eqNullSafe(DELETE))
    else:
        if op_col:
            take_s = has_s & (~has_t | op.eqNullSafe(INSERT) | op.isNull())
            drop = has_s & op.eqNullSafe(DELETE) & (has_t | F.lit(unmatched_delete == "skip"))
        else:
            take_s = has_s
            drop = F.lit(False)
        # columns the source lacks keep the target's value
        out = j.where(~drop).select(*[
            (F.when(take_s, F.col(f"source_table.{c}")) if c in source.columns else F.when(F.lit(False), F.lit(None).cast(dt)))
            .otherwise(_col_or_null(target, "target_table", c, dt)).alias(c) for c, dt in cols])

    ins = bypass_s
    if op_col and unmatched_delete == "skip":
        ins = ins.where(~F.col(op_col).eqNullSafe(DELETE))
    return out.unionByName(_align(bypass_t, cols)).unionByName(_align(ins, cols))


# Change sets within both bounds are broadcast whole.
BROADCAST_MAX_ROWS = 2_000_000
BROADCAST_MAX_BYTES = 256 << 20


def _is_small(source: DataFrame, keys: Sequence[str], strategy: str, max_rows: int,
              op_col: str | None = None, max_bytes: int = BROADCAST_MAX_BYTES) -> bool:
    """Whether the change set is broadcast. All of its columns are, so all are measured."""
    if strategy != "auto":
        return strategy == "broadcast"
    missing = [c for c in (*keys, *([op_col] if op_col else [])) if c not in source.columns]
    if missing:
        raise ValueError(f"the change set lacks {missing}")
    # rows and bytes of the change set, one distributed pass; the target is never counted
    return sizing.within(source, max_rows, max_bytes)


def _merge_keyed(target: DataFrame, source: DataFrame, keys: Sequence[str], op_col: str | None, unmatched_delete: str,
                 strategy: str, max_rows: int) -> DataFrame:
    """A keyed merge by the strategy. Unless it is ``shuffle``, the change set is checked for
    repeated keys and written to the checkpoint folder once; its size, the merge and the
    inserts read that. The target is scanned whole once, and a second time for its keys."""
    if unmatched_delete not in ("skip", "insert"):
        raise ValueError("unmatched_delete must be 'skip' or 'insert'")
    if strategy not in ("auto", "broadcast", "shuffle"):
        raise ValueError(f"unknown merge strategy {strategy!r}")
    missing = [c for c in (*keys, *([op_col] if op_col else [])) if c not in source.columns]
    if missing:
        raise ValueError(f"the change set lacks {missing}")
    if strategy == "shuffle":
        return _merge(target, source, keys=keys, op_col=op_col, unmatched_delete=unmatched_delete, coalesce_values=False)
    shared_dir(target.sparkSession)
    written = one_row_per_key_or_null(source, keys).checkpoint()
    if not _is_small(written, keys, strategy, max_rows, op_col):
        return _merge(target, written, keys=keys, op_col=op_col, unmatched_delete=unmatched_delete, coalesce_values=False, checked=True)
    null = _any_null(keys)
    changes = written.where(~null)
    # distinct (map-side) bounds the matched keys by the change set, whatever the target repeats
    met = target.select(*keys).join(F.broadcast(changes.select(*keys)), list(keys), "left_semi").distinct()
    parts = [matched_outcomes(target, changes, keys, op_col),
             unmatched_outcomes(changes, met, keys, op_col, unmatched_delete),
             unmatched_outcomes(written.where(null), met.where("false"), keys, op_col, unmatched_delete)]
    cols = [(c, t) for c, t in _out_columns(target, written) if c != ACTION]
    return _union_all([_align(p.where(~F.col(OUTCOME).isin("deleted", "skipped")), cols) for p in parts])


def _union_all(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def merge_ops(target: DataFrame, source: DataFrame, keys: Sequence[str], op_col: str,
              *, unmatched_delete: str = "skip", strategy: str = "auto",
              broadcast_max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """Matched & op ``D`` → delete; matched & op ``I`` or null → source row (all columns,
    nulls included); matched & another op → target row stays; not matched → insert,
    except op ``D`` which is skipped unless ``unmatched_delete='insert'``.

    Every target row of a repeated target key is treated alike, and columns the change set
    lacks keep the target's value. ``strategy``: ``shuffle`` (full outer join),
    ``broadcast`` (change set broadcast), or ``auto`` (broadcast when the change set is
    measured to be within ``broadcast_max_rows`` rows and ``BROADCAST_MAX_BYTES``); all
    give the same rows."""
    out = _merge_keyed(target, source, keys, op_col, unmatched_delete, strategy, broadcast_max_rows)
    return out.drop(ACTION) if op_col == ACTION else out


def merge_upsert(target: DataFrame, source: DataFrame, keys: Sequence[str], *, strategy: str = "auto",
                 broadcast_max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """Matched → source row; not matched → insert."""
    return _merge_keyed(target, source, keys, None, "insert", strategy, broadcast_max_rows)


def _content(df: DataFrame) -> Column:
    """Digest of all columns of a row. JSON tells nulls and columns apart; times are written
    to the microsecond."""
    times = {k: "yyyy-MM-dd'T'HH:mm:ss.SSSSSS" + zone for k, zone in (("timestampFormat", "XXX"), ("timestampNTZFormat", ""))}
    return F.unhex(F.md5(F.to_json(F.struct(*[df[f"`{c}`"] for c in df.columns]), times).cast("binary")))


def merge_condition(target: DataFrame, source: DataFrame, condition: str, *, overlap: ranges.Overlap | None = None,
                    op_col: str | None = None, unmatched_delete: str = "skip") -> DataFrame:
    """Merge on a SQL condition over ``target_table`` / ``source_table``: matched → source row
    (by ``op_col`` as in ``merge_ops``), not matched → insert.

    With an equality between the two, Spark hash-partitions on it. Otherwise the condition
    must be a range: comparisons of a target column with a source column both ways
    (``target_table.lo <= source_table.x AND source_table.x < target_table.hi``, or BETWEEN),
    or ``overlap`` names the columns; it is joined on bins (``ranges.pairs``). Any other
    condition would compare every pair, so it raises. A target row that several different
    source rows match raises too, as in a lakehouse ``MERGE``.

    Rows are known by their content: the pairs are joined once, written to the checkpoint
    folder, and met again by both sides. Rows whose condition is null match nothing."""
    if unmatched_delete not in ("skip", "insert"):
        raise ValueError("unmatched_delete must be 'skip' or 'insert'")
    cols = _out_columns(target, source)
    t, s = target.withColumn(_T, _content(target)), source.withColumn(_S, _content(source))
    on = F.expr(condition)
    if ranges.has_equality(condition):
        found = t.alias("target_table").join(s.alias("source_table"), on, "inner")
    else:
        overlap = overlap or ranges.overlap_of(condition)
        if overlap is None:
            raise ValueError("the merge condition needs an equality between target_table and source_table, "
                             f"or a range that bounds their columns both ways: {condition}")
        found = ranges.pairs(t.dropDuplicates([_T]), s.dropDuplicates([_S]), overlap, on)
    shared_dir(target.sparkSession)
    source_row = F.struct(*[F.col(f"source_table.`{c}`").alias(c) for c in source.columns])
    found = found.select(_T, _S, source_row.alias(_ROW)).checkpoint()
    once = found.groupBy(F.col(_T).alias(_N)).agg(F.min(_S).alias("lo"), F.max(_S).alias("hi"), F.any_value(_ROW).alias(_ROW))
    if not once.where("lo <> hi").isEmpty():
        raise ValueError(f"several source rows match one target row: {condition}")
    hit, op = F.col(_ROW).isNotNull(), (F.col(f"{_ROW}.`{op_col}`") if op_col else F.lit(None).cast("string"))
    take = hit & (op.isNull() | op.eqNullSafe(INSERT)) if op_col else hit
    drop = hit & op.eqNullSafe(DELETE) if op_col else F.lit(False)
    kept = t.join(once.select(_N, _ROW), F.col(_T) == F.col(_N), "left").where(~drop).select(*[
        (F.when(take, F.col(f"{_ROW}.`{c}`")) if c in source.columns else F.when(F.lit(False), F.lit(None).cast(dt)))
        .otherwise(F.col(f"`{c}`") if c in target.columns else F.lit(None).cast(dt)).alias(c) for c, dt in cols])
    inserts = s.join(found.select(F.col(_S).alias(_N)).distinct(), F.col(_S) == F.col(_N), "left_anti")
    if op_col and unmatched_delete == "skip":
        inserts = inserts.where(~F.col(f"`{op_col}`").eqNullSafe(DELETE))
    return kept.unionByName(_align(inserts, cols))


def merge_coalesce(target: DataFrame, source: DataFrame, keys: Sequence[str], *,
                   op_col: str | None = None) -> DataFrame:
    """Per column: source value if not null, else target value; then rows whose
    resulting op is ``D`` are dropped (a null op is kept)."""
    return _merge(target, source, keys=keys, op_col=op_col, unmatched_delete="insert", coalesce_values=True)


ACTION = "__kf_action"
#: What became of a row: kept, updated, left (matched by an op without effect), deleted,
#: inserted, skipped (an unmatched delete); and the file that a change came from.
OUTCOME, FILE = "__kf_outcome", "__kf_file"


def one_row_per_key_or_null(source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``one_row_per_key`` for rows with whole keys; rows with a null key pass."""
    null = _any_null(keys)
    return one_row_per_key(source.where(~null), keys).unionByName(source.where(null))


def _decide(has_t: Column, has_s: Column, op: Column | None, unmatched_delete: str) -> Column:
    gone = op.eqNullSafe(DELETE) if op is not None else F.lit(False)
    sets = op.isNull() | (op == INSERT) if op is not None else F.lit(True)
    return (F.when(~has_s, "kept").when(~has_t & gone & F.lit(unmatched_delete == "skip"), "skipped").when(~has_t, "inserted")
            .when(gone, "deleted").when(sets, "updated").otherwise("left"))


def _on(keys: Sequence[str]) -> Column:
    on = F.lit(True)
    for k in keys:
        on = on & (F.col(f"target_table.`{k}`") == F.col(f"source_table.`{k}`"))
    return on


def _judged(joined: DataFrame, target: DataFrame, source: DataFrame, op_col: str | None, unmatched_delete: str) -> DataFrame:
    """The joined rows with their outcome: the source's values where they count, else the
    target's, which a column the source lacks keeps."""
    op = F.col(f"source_table.`{op_col}`") if op_col else None
    outcome = _decide(F.col(f"target_table.{_T}").isNotNull(), F.col(f"source_table.{_S}").isNotNull(), op, unmatched_delete)
    taken = outcome.isin("updated", "inserted")
    cols = [(c, t) for c, t in _out_columns(target, source) if c not in (FILE, ACTION)]
    values = [(F.when(taken, F.col(f"source_table.`{c}`")) if c in source.columns else F.when(F.lit(False), F.lit(None).cast(t)))
              .otherwise(F.col(f"target_table.`{c}`") if c in target.columns else F.lit(None).cast(t)).alias(c) for c, t in cols]
    file = [F.col(f"source_table.{FILE}").alias(FILE)] if FILE in source.columns else []
    return joined.select(*values, *file, outcome.alias(OUTCOME))


def outcomes(target: DataFrame, source: DataFrame, keys: Sequence[str], op_col: str | None,
             unmatched_delete: str = "skip") -> DataFrame:
    """Every row of the merge with its outcome, dropped ones too: one full outer join; rows
    with a null key bypass it. ``source`` holds one row per key."""
    null = _any_null(keys)
    t, s = target.withColumn(_T, F.lit(True)), source.withColumn(_S, F.lit(True))
    joined = t.where(~null).alias("target_table").join(s.where(~null).alias("source_table"), _on(keys), "full_outer")
    whole = _judged(joined, target, source, op_col, unmatched_delete)
    never = F.lit(False)
    lone_t = t.where(null).alias("target_table").join(s.where(never).alias("source_table"), never, "left")
    lone_s = s.where(null).alias("source_table").join(t.where(never).alias("target_table"), never, "left")
    return whole.unionByName(_judged(lone_t, target, source, op_col, unmatched_delete)).unionByName(
        _judged(lone_s, target, source, op_col, unmatched_delete))


def matched_outcomes(target: DataFrame, source: DataFrame, keys: Sequence[str], op_col: str | None) -> DataFrame:
    """The target's rows with their outcome. ``source``, of a checked size, is broadcast, and
    the target streams through."""
    t, s = target.withColumn(_T, F.lit(True)).alias("target_table"), source.withColumn(_S, F.lit(True)).alias("source_table")
    return _judged(t.join(F.broadcast(s), _on(keys), "left"), target, source, op_col, "skip")


def unmatched_outcomes(source: DataFrame, met: DataFrame, keys: Sequence[str], op_col: str | None,
                       unmatched_delete: str = "skip") -> DataFrame:
    """The rows of ``source`` whose key is not in ``met`` (no larger than ``source``)."""
    alone = source.join(F.broadcast(met), list(keys), "left_anti").select(*[F.col(f"`{c}`") for c in source.columns])
    outcome = _decide(F.lit(False), F.lit(True), F.col(f"`{op_col}`") if op_col else None, unmatched_delete)
    return alone.withColumn(OUTCOME, outcome).drop(ACTION)


def fold_changes(changes: DataFrame, keys: Sequence[str], op_col: str,
                 order: Sequence[Column | str]) -> DataFrame:
    """Reduce change rows of several batches (e.g. landed files) to one row per key
    whose merge (``merge_ops`` with ``op_col=ACTION``, unmatched deletes skipped)
    equals merging the batches one after another in ``order``.

    Applied in order, ``I`` / null set the row, ``D`` removes it, and any other op
    keeps a present row or inserts its own into an absent key. So per key, with
    *d* the last row whose op is ``I``, ``D`` or null, and *u* the first row after
    *d* (or the first row, if there is no *d*):
    * *d* is ``I`` / null → *d*'s row replaces (action = its op);
    * *d* is ``D`` → *u*'s row is written whatever the target holds (action ``I``),
      or, without *u*, the key is deleted (action ``D``);
    * no *d* → *u*'s row with its own op (keeps a present row, else inserted).

    Window aggregates over the key, no collection of rows: a key holds at most
    one row per batch once each batch is reduced per key, so a group is bounded
    by the number of batches. The result carries ``ACTION``; ``merge_ops`` drops it."""
    keys = list(keys)
    op = F.col(op_col)
    pos, last_d, d_del, first_u = "__kf_pos", "__kf_ld", "__kf_ldd", "__kf_fu"
    order_cols = [F.col(c) if isinstance(c, str) else c for c in order]
    rest = [f.name for f in changes.schema.fields if f.name not in keys and not isinstance(f.dataType, MapType)]
    w_ord = Window.partitionBy(*keys).orderBy(*order_cols, *[F.col(f"`{c}`").asc_nulls_first() for c in rest])
    w = Window.partitionBy(*keys)
    decisive = op.isNull() | op.isin(INSERT, DELETE)
    x = changes.withColumn(pos, F.row_number().over(w_ord))
    x = x.withColumn(last_d, F.max(F.when(decisive, F.col(pos))).over(w))
    x = (x.withColumn(d_del, F.max(F.when((F.col(pos) == F.col(last_d)) & op.eqNullSafe(DELETE), F.lit(True))).over(w))
          .withColumn(first_u, F.min(F.when(F.col(last_d).isNull() | (F.col(pos) > F.col(last_d)), F.col(pos))).over(w)))
    ld, fu, is_del = F.col(last_d), F.col(first_u), F.coalesce(F.col(d_del), F.lit(False))
    pick = (F.when(ld.isNotNull() & ~is_del, F.col(pos) == ld)
            .when(ld.isNotNull() & fu.isNotNull(), F.col(pos) == fu)
            .when(ld.isNotNull(), F.col(pos) == ld)
            .otherwise(F.col(pos) == fu))
    action = (F.when(ld.isNotNull() & ~is_del, op)
              .when(ld.isNotNull() & fu.isNotNull(), F.lit(INSERT))
              .when(ld.isNotNull(), F.lit(DELETE))
              .otherwise(op))
    return x.where(pick).withColumn(ACTION, action).drop(pos, last_d, d_del, first_u)


def first_load(source: DataFrame, op_col: str | None = None) -> DataFrame:
    """Content of a table created from a change set: everything but deletes."""
    if op_col:
        out = source.where(~F.col(op_col).eqNullSafe(DELETE))
        return out.drop(ACTION) if op_col == ACTION else out
    return source
