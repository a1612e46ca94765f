"""Registered queries: one Spark function per operator key of the survey, each
reading the given tables (or data Spark derives from them), and the DuckDB SQL
that computes the same result on the same parquet tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keyfold import fixtures as fx
from keyfold.functions import fiscal, hooks, labels, transforms
from keyfold.operators import dedupe, merge, quality, reconcile
from keyfold.operators import snapshots
from keyfold.plans import ingest
from keyfold.plans.steplog import timing_report
from keyfold.session import scratch_path
from keyfold.sinks import routing, writes
from keyfold.sinks.layers import LayerTable
from keyfold.sources import delimited, listing, lookup, tables
from keyfold.streaming.file_stream import FileStream

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(key: str, sql: str | None = None):
    def deco(fn):
        QUERIES[key] = fn
        if sql is not None:
            ORACLES[key] = sql.strip()
        return fn
    return deco


# ================================================================= shared SQL pieces
ORDER_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority", "op"]
CDC = """cdc AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority,
  CASE WHEN o_orderkey % 5 = 1 THEN 'U' WHEN o_orderstatus = 'F' THEN 'D' WHEN o_orderstatus = 'O' THEN 'I' END AS op
  FROM orders),
t AS (SELECT *, true AS _t FROM cdc WHERE o_orderkey % 10 <> 0)"""
CDC_REPEATED = CDC.removesuffix(")") + """
  UNION ALL SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice + 7, o_orderdate, o_orderpriority, op, true
  FROM cdc WHERE o_orderkey % 10 <> 0 AND o_orderkey % 7 = 0)"""
SRC = """s AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice + 100 AS o_totalprice, o_orderdate,
  o_orderpriority, op, true AS _s FROM cdc WHERE o_orderkey % 3 = 0 OR o_orderkey % 10 = 0)"""


def _pick(take_s: str, on: str, where: str = "true", cols=ORDER_COLS) -> str:
    sel = ", ".join(f"CASE WHEN {take_s} THEN s.{c} ELSE t.{c} END AS {c}" for c in cols)
    return f"SELECT {sel} FROM t FULL OUTER JOIN s ON {on} WHERE {where}"


ON_KEY = "t.o_orderkey = s.o_orderkey"


# ================================================================= flagship
def current_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Current state per user after the change feed: state from the first half of
    January, changes (latest per user) from the second half, merged by op."""
    ev = fx.events_raw(spark, sf_dir)
    first = ev.where(F.dayofmonth("ts") <= 15)
    later = ev.where(F.dayofmonth("ts") > 15)
    state = merge.first_load(dedupe.latest_per_key(first, ["user_id"], "event_id"), "op")
    changes = dedupe.latest_per_key(later, ["user_id"], "event_id")
    # both sides are partitioned and sorted by user already, so the merge join needs no shuffle
    return merge.merge_ops(state, changes, ["user_id"], "op", strategy="shuffle")


EV_COLS = ["event_id", "ts", "user_id", "event_type", "value", "props", "op"]
EV_RAW = """ev AS (SELECT event_id, ts, user_id, event_type, value, props,
  CASE WHEN event_type = 'error' THEN 'D' WHEN event_type = 'signup' THEN 'I' WHEN event_type = 'click' THEN 'U' END AS op,
  CAST(least(floor((day(ts) - 1) / 6), 4) AS INTEGER) AS file_idx,
  'events_2024.01.' || lpad(CAST(CAST(least(floor((day(ts) - 1) / 6), 4) AS INTEGER) * 6 + 1 AS VARCHAR), 2, '0') || '.csv' AS file_name
  FROM events)"""
_ev_sel = ", ".join(EV_COLS)
_ev_pick = ", ".join(f"CASE WHEN s._s IS NOT NULL AND (t._t IS NULL OR s.op IS NOT DISTINCT FROM 'I' OR s.op IS NULL) "
                     f"THEN s.{c} ELSE t.{c} END AS {c}" for c in EV_COLS)
ORACLES_CURRENT_STATE = f"""
WITH {EV_RAW},
t AS (SELECT {_ev_sel}, true AS _t FROM ev WHERE day(ts) <= 15
      QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1),
s AS (SELECT {_ev_sel}, true AS _s FROM ev WHERE day(ts) > 15
      QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1),
t2 AS (SELECT * FROM t WHERE op IS DISTINCT FROM 'D')
SELECT {_ev_pick} FROM t2 AS t FULL OUTER JOIN s ON t.user_id = s.user_id
WHERE NOT (s._s IS NOT NULL AND s.op IS NOT DISTINCT FROM 'D')"""
register("current_state", ORACLES_CURRENT_STATE)(current_state)


# ================================================================= 2.6 window
@register("latest_per_key", """
SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1""")
def q_latest_per_key(spark, sf_dir):
    return dedupe.latest_per_key(fx.table(spark, sf_dir, "events"), ["user_id"], "event_id")


# ================================================================= 2.2 merges
@register("merge_ops", f"WITH {CDC_REPEATED}, {SRC} " + _pick(
    "s._s IS NOT NULL AND (t._t IS NULL OR s.op IS NOT DISTINCT FROM 'I' OR s.op IS NULL)", ON_KEY,
    "NOT (s._s IS NOT NULL AND s.op IS NOT DISTINCT FROM 'D')"))
def q_merge_ops(spark, sf_dir):
    return merge.merge_ops(fx.cdc_target_repeated(spark, sf_dir), fx.cdc_source(spark, sf_dir), ["o_orderkey"], "op")


@register("merge_upsert", f"WITH {CDC_REPEATED}, {SRC} " + _pick("s._s IS NOT NULL", ON_KEY))
def q_merge_upsert(spark, sf_dir):
    return merge.merge_upsert(fx.cdc_target_repeated(spark, sf_dir), fx.cdc_source(spark, sf_dir), ["o_orderkey"])


SRC_COND = """s AS (SELECT o_orderkey, o_custkey, o_orderstatus,
  o_totalprice + CASE WHEN o_orderkey % 2 = 0 THEN 100 ELSE -100 END AS o_totalprice, o_orderdate,
  o_orderpriority, op, true AS _s FROM cdc WHERE o_orderkey % 3 = 0 OR o_orderkey % 10 = 0)"""


@register("merge_condition", f"WITH {CDC}, {SRC_COND} " + _pick(
    "s._s IS NOT NULL", "t.o_orderkey = s.o_orderkey AND s.o_totalprice > t.o_totalprice"))
def q_merge_condition(spark, sf_dir):
    src = (fx.orders_cdc(spark, sf_dir).where(fx.in_source())
           .withColumn("o_totalprice", F.col("o_totalprice") +
                       F.when(F.col("o_orderkey") % 2 == 0, F.lit(100)).otherwise(F.lit(-100))))
    return merge.merge_condition(
        fx.cdc_target(spark, sf_dir), src,
        "target_table.o_orderkey = source_table.o_orderkey AND source_table.o_totalprice > target_table.o_totalprice")


@register("merge_condition_range", """
WITH t AS (SELECT o_orderkey, o_totalprice, o_orderpriority FROM orders),
s AS (SELECT p_partkey * 50.0 AS lo, p_partkey * 50.0 + p_size AS hi, p_brand AS o_orderpriority,
             CASE WHEN p_size % 7 = 0 THEN 'D' WHEN p_size % 5 = 0 THEN 'U' WHEN p_size % 2 = 0 THEN 'I' END AS op FROM part),
j AS (SELECT t.*, s.lo, s.hi, s.o_orderpriority AS new_priority, s.op, s.lo IS NOT NULL AS hit
      FROM t LEFT JOIN s ON s.lo <= t.o_totalprice AND t.o_totalprice < s.hi)
SELECT o_orderkey, o_totalprice, CASE WHEN hit AND op IS DISTINCT FROM 'U' THEN new_priority ELSE o_orderpriority END AS o_orderpriority,
  CASE WHEN op IS DISTINCT FROM 'U' THEN lo END AS lo, CASE WHEN op IS DISTINCT FROM 'U' THEN hi END AS hi,
  CASE WHEN op IS DISTINCT FROM 'U' THEN op END AS op FROM j WHERE op IS DISTINCT FROM 'D'
UNION ALL SELECT NULL, NULL, o_orderpriority, lo, hi, op FROM s
WHERE op IS DISTINCT FROM 'D' AND NOT EXISTS (SELECT 1 FROM t WHERE s.lo <= t.o_totalprice AND t.o_totalprice < s.hi)""")
def q_merge_condition_range(spark, sf_dir):
    """Price bands (a part's, disjoint) applied to the orders whose price lies in them: a range, no equality."""
    p, size = fx.table(spark, sf_dir, "part"), F.col("p_size")
    bands = p.select((F.col("p_partkey") * 50.0).alias("lo"), (F.col("p_partkey") * 50.0 + size).alias("hi"),
                     F.col("p_brand").alias("o_orderpriority"),
                     F.when(size % 7 == 0, "D").when(size % 5 == 0, "U").when(size % 2 == 0, "I").alias("op"))
    return merge.merge_condition(
        fx.table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderpriority"), bands,
        "source_table.lo <= target_table.o_totalprice AND target_table.o_totalprice < source_table.hi", op_col="op")


SRC_NULLS = """s AS (SELECT o_orderkey, o_custkey, o_orderstatus,
  CASE WHEN o_orderkey % 6 = 0 THEN NULL ELSE o_totalprice + 100 END AS o_totalprice, o_orderdate,
  CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE o_orderpriority END AS o_orderpriority,
  CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE op END AS op, true AS _s FROM cdc WHERE o_orderkey % 3 = 0 OR o_orderkey % 10 = 0)"""


def _source_with_nulls(spark, sf_dir):
    k = F.col("o_orderkey")
    return (fx.orders_cdc(spark, sf_dir).where(fx.in_source()).select(
        "o_orderkey", "o_custkey", "o_orderstatus",
        F.when(k % 6 == 0, F.lit(None)).otherwise(F.col("o_totalprice") + 100).alias("o_totalprice"),
        "o_orderdate",
        F.when(k % 4 == 0, F.lit(None)).otherwise(F.col("o_orderpriority")).alias("o_orderpriority"),
        F.when(k % 9 == 0, F.lit(None)).otherwise(F.col("op")).alias("op")))


@register("merge_coalesce", f"WITH {CDC}, {SRC_NULLS} SELECT " +
          ", ".join(f"coalesce(s.{c}, t.{c}) AS {c}" for c in ORDER_COLS) +
          f" FROM t FULL OUTER JOIN s ON {ON_KEY} WHERE coalesce(s.op, t.op) IS DISTINCT FROM 'D'")
def q_merge_coalesce(spark, sf_dir):
    return merge.merge_coalesce(fx.cdc_target(spark, sf_dir), _source_with_nulls(spark, sf_dir),
                                ["o_orderkey"], op_col="op")


def _table_name(what: str) -> str:
    return f"kf_{what}_{uuid.uuid4().hex[:12]}"


def _layer(spark, base: str, what: str, **layout) -> LayerTable:
    """A named table below ``base`` in the shared folder."""
    return LayerTable(spark, _table_name(what), location=f"{base}/{what}", **layout)


@register("create_if_absent", f"WITH {CDC} SELECT {', '.join(ORDER_COLS)} FROM cdc "
          "WHERE op IS DISTINCT FROM 'D'")
def q_create_if_absent(spark, sf_dir):
    tbl = _layer(spark, scratch_path(spark, "create_if_absent"), "orders", keys=["o_orderkey"])
    existed = tbl.create_if_absent(fx.orders_cdc(spark, sf_dir), "op")
    assert not existed
    return tbl.read()


# ================================================================= 2.5 aggregations / 2.4 joins
@register("dup_keys", """
SELECT l_orderkey, l_linenumber, count(*) AS cnt FROM lineitem
WHERE l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL
GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""")
def q_dup_keys(spark, sf_dir):
    return dedupe.dup_keys(fx.table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@register("dup_key_seq", """
SELECT l_orderkey, l_linenumber, l_shipdate, count(*) AS cnt FROM lineitem
WHERE l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL AND l_shipdate IS NOT NULL
GROUP BY l_orderkey, l_linenumber, l_shipdate HAVING count(*) > 1""")
def q_dup_key_seq(spark, sf_dir):
    return dedupe.dup_keys(fx.table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber", "l_shipdate"])


@register("dup_inspect", """
SELECT l.*, d.cnt FROM lineitem l JOIN (
  SELECT l_orderkey, l_linenumber, count(*) AS cnt FROM lineitem
  WHERE l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL
  GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1) d
USING (l_orderkey, l_linenumber)""")
def q_dup_inspect(spark, sf_dir):
    return dedupe.dup_inspect(fx.table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@register("drop_null_any", """
SELECT o_orderkey, o_custkey, k_status AS o_orderstatus, o_totalprice, o_orderdate, k_priority AS o_orderpriority
FROM (SELECT *, nullif(o_orderpriority, '5-LOW') AS k_priority, nullif(o_orderstatus, 'F') AS k_status FROM orders)
WHERE k_priority IS NOT NULL AND k_status IS NOT NULL""")
def q_drop_null_any(spark, sf_dir):
    return dedupe.drop_null_keys(_orders_null_keys(spark, sf_dir), ["o_orderpriority", "o_orderstatus"], "any")


@register("drop_null_all", """
SELECT o_orderkey, o_custkey, k_status AS o_orderstatus, o_totalprice, o_orderdate, k_priority AS o_orderpriority
FROM (SELECT *, nullif(o_orderpriority, '5-LOW') AS k_priority, nullif(o_orderstatus, 'F') AS k_status FROM orders)
WHERE k_priority IS NOT NULL OR k_status IS NOT NULL""")
def q_drop_null_all(spark, sf_dir):
    return dedupe.drop_null_keys(_orders_null_keys(spark, sf_dir), ["o_orderpriority", "o_orderstatus"], "all")


def _orders_null_keys(spark, sf_dir):
    o = fx.table(spark, sf_dir, "orders")
    return o.withColumns({"o_orderpriority": F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")),
                          "o_orderstatus": F.nullif(F.col("o_orderstatus"), F.lit("F"))})


# ================================================================= 2.8 data quality
LI_KEYS, LI_SEQ = ["l_orderkey", "l_linenumber"], "l_shipdate"
DQ_SQL = """raw AS (SELECT
  CASE WHEN l_orderkey % 20 = 3 AND l_linenumber = 1 THEN NULL ELSE l_orderkey END AS l_orderkey,
  l_partkey, l_suppkey,
  CASE WHEN (l_orderkey % 20 = 3 AND l_linenumber = 1) OR l_orderkey % 20 = 4 THEN NULL ELSE l_linenumber END AS l_linenumber,
  l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate,
  'part_' || CAST(l_orderkey % 20 AS VARCHAR) AS file_name FROM lineitem),
l1 AS (SELECT file_name, l_orderkey, l_linenumber, l_shipdate, count(*) AS c FROM raw
       GROUP BY file_name, l_orderkey, l_linenumber, l_shipdate),
l2 AS (SELECT file_name, l_orderkey, l_linenumber, sum(c) AS n, count_if(l_shipdate IS NOT NULL AND c > 1) AS seq_dups
       FROM l1 GROUP BY file_name, l_orderkey, l_linenumber),
l3 AS (SELECT file_name, CAST(sum(n) AS BIGINT) AS n_rows,
  CAST(sum(CASE WHEN l_orderkey IS NULL AND l_linenumber IS NULL THEN n ELSE 0 END) AS BIGINT) AS n_all_null_keys,
  CAST(count_if(l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL AND n > 1) AS BIGINT) AS n_dup_keys,
  CAST(sum(CASE WHEN l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL THEN seq_dups ELSE 0 END) AS BIGINT) AS n_dup_key_seq
  FROM l2 GROUP BY file_name),
listing AS (SELECT 'part_' || CAST(i AS VARCHAR) AS file_name FROM range(21) r(i)),
v0 AS (SELECT file_name, coalesce(n_rows, 0) AS n_rows, coalesce(n_all_null_keys, 0) AS n_all_null_keys,
  coalesce(n_dup_keys, 0) AS n_dup_keys, coalesce(n_dup_key_seq, 0) AS n_dup_key_seq
  FROM listing LEFT JOIN l3 USING (file_name)),
v1 AS (SELECT *, CASE WHEN n_rows = 0 THEN 'EmptyError' WHEN n_all_null_keys > 0 THEN 'KeysNull'
  WHEN n_dup_key_seq > 0 THEN 'DuplicatedFound' WHEN n_dup_keys > 0 THEN 'DuplicatedKeyNewerSequence' END AS code FROM v0),
verdicts AS (SELECT *, CASE WHEN code IN ('EmptyError', 'KeysNull', 'DuplicatedFound') THEN '10'
  WHEN code = 'DuplicatedKeyNewerSequence' THEN '20' END AS severity FROM v1)"""


def _policy_sql(fatal: tuple[str, ...]) -> str:
    f = ", ".join(f"'{c}'" for c in fatal) or "NULL"
    return f"""policy0 AS (SELECT *, CASE WHEN code IN ({f}) THEN 'stop'
  WHEN code IN ('EmptyError', 'DuplicatedFound') THEN 'reject' ELSE 'accept' END AS raw_action FROM verdicts),
policy AS (SELECT * EXCLUDE (raw_action), CASE WHEN coalesce(max(CASE WHEN raw_action = 'stop' THEN 1 ELSE 0 END)
  OVER (ORDER BY file_name ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) = 1 THEN 'skip'
  ELSE raw_action END AS action FROM policy0)"""


def _dq_verdicts(spark, sf_dir):
    return quality.dq_check(fx.lineitem_files(spark, sf_dir), LI_KEYS, LI_SEQ, listing=fx.lineitem_listing(spark))


@register("dq_check", f"WITH {DQ_SQL} SELECT * FROM verdicts")
def q_dq_check(spark, sf_dir):
    return _dq_verdicts(spark, sf_dir)


@register("dq_empty", f"WITH {DQ_SQL} SELECT file_name FROM listing WHERE file_name NOT IN (SELECT file_name FROM raw)")
def q_dq_empty(spark, sf_dir):
    return quality.dq_empty(fx.lineitem_files(spark, sf_dir), fx.lineitem_listing(spark))


@register("dq_null_keys", """
SELECT 'part_' || CAST(l_orderkey % 20 AS VARCHAR) AS file_name,
  CAST(count_if(l_orderkey % 20 = 3 AND l_linenumber = 1) AS BIGINT) AS n_all_null_keys
FROM lineitem GROUP BY 1 HAVING count_if(l_orderkey % 20 = 3 AND l_linenumber = 1) > 0""")
def q_dq_null_keys(spark, sf_dir):
    return quality.dq_null_keys(fx.lineitem_files(spark, sf_dir), LI_KEYS)


@register("dq_duplicates", f"WITH {DQ_SQL} SELECT file_name, n_dup_keys, n_dup_key_seq FROM l3 WHERE n_dup_key_seq > 0")
def q_dq_duplicates(spark, sf_dir):
    return quality.dq_duplicates(fx.lineitem_files(spark, sf_dir), LI_KEYS, LI_SEQ)


@register("dq_dup_sequence", f"WITH {DQ_SQL} SELECT file_name, n_dup_keys, n_dup_key_seq FROM l3 "
          "WHERE n_dup_keys > 0 AND n_dup_key_seq = 0")
def q_dq_dup_sequence(spark, sf_dir):
    return quality.dq_dup_sequence(fx.lineitem_files(spark, sf_dir), LI_KEYS, LI_SEQ)


@register("dq_policy", f"WITH {DQ_SQL}, {_policy_sql(('KeysNull',))} SELECT * FROM policy")
def q_dq_policy(spark, sf_dir):
    return quality.dq_policy(_dq_verdicts(spark, sf_dir), fatal=(quality.KEYS_NULL,))


@register("verdict_join", f"WITH {DQ_SQL}, {_policy_sql(())} SELECT raw.* FROM raw "
          "WHERE file_name IN (SELECT file_name FROM policy WHERE action = 'accept')")
def q_verdict_join(spark, sf_dir):
    verdicts = quality.dq_policy(_dq_verdicts(spark, sf_dir))
    return quality.verdict_join(fx.lineitem_files(spark, sf_dir), verdicts)


@register("route_files", f"WITH {DQ_SQL}, {_policy_sql(('KeysNull',))} SELECT *, "
          "CASE WHEN action = 'accept' THEN 'landing/archive/' || file_name "
          "WHEN action IN ('reject', 'stop') THEN 'landing/error/' || file_name END AS destination FROM policy")
def q_route_files(spark, sf_dir):
    verdicts = quality.dq_policy(_dq_verdicts(spark, sf_dir), fatal=(quality.KEYS_NULL,))
    return routing.route_files(verdicts, "landing/archive", "landing/error")


# ================================================================= reconcile / snapshots
RECON_SQL = """l AS (SELECT o_orderkey, o_totalprice, o_orderpriority FROM orders),
r AS (SELECT o_orderkey,
        CASE WHEN o_orderkey % 14 = 0 THEN NULL WHEN o_orderkey % 7 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice,
        CASE WHEN o_orderkey % 13 = 0 THEN '9-NEW' ELSE o_orderpriority END AS o_orderpriority
      FROM orders WHERE o_orderkey % 11 <> 0
      UNION ALL SELECT -(o_orderkey + 1), o_totalprice, o_orderpriority FROM orders WHERE o_orderkey % 17 = 0),
j AS (SELECT coalesce(l.o_orderkey, r.o_orderkey) AS o_orderkey,
  CASE WHEN r.o_orderkey IS NULL THEN 'left_only' WHEN l.o_orderkey IS NULL THEN 'right_only'
       WHEN l.o_totalprice IS DISTINCT FROM r.o_totalprice OR l.o_orderpriority IS DISTINCT FROM r.o_orderpriority
       THEN 'changed' END AS status,
  l.o_totalprice AS left_o_totalprice, r.o_totalprice AS right_o_totalprice,
  l.o_orderpriority AS left_o_orderpriority, r.o_orderpriority AS right_o_orderpriority
  FROM l FULL OUTER JOIN r ON l.o_orderkey = r.o_orderkey),
recon AS (SELECT * FROM j WHERE status IS NOT NULL)"""
RECON_COLS = ["o_totalprice", "o_orderpriority"]


def _recon(spark, sf_dir):
    o = fx.table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    right = (o.where(k % 11 != 0).select(
        "o_orderkey",
        F.when(k % 14 == 0, F.lit(None)).when(k % 7 == 0, F.col("o_totalprice") + 1)
         .otherwise(F.col("o_totalprice")).alias("o_totalprice"),
        F.when(k % 13 == 0, F.lit("9-NEW")).otherwise(F.col("o_orderpriority")).alias("o_orderpriority"))
        .unionByName(o.where(k % 17 == 0).select((-(k + 1)).alias("o_orderkey"), "o_totalprice", "o_orderpriority")))
    return reconcile.reconcile(o, right, ["o_orderkey"], RECON_COLS)


@register("reconcile", f"WITH {RECON_SQL} SELECT * FROM recon")
def q_reconcile(spark, sf_dir):
    return _recon(spark, sf_dir)


@register("reconcile_copies", """
WITH l AS (SELECT o_custkey, o_orderpriority, o_orderstatus FROM orders),
r AS (SELECT o_custkey, CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE o_orderpriority END AS o_orderpriority, o_orderstatus
      FROM orders WHERE o_orderkey % 11 <> 0),
u AS (SELECT *, 1 AS a, 0 AS b FROM l UNION ALL SELECT *, 0, 1 FROM r),
c AS (SELECT o_custkey, o_orderpriority, o_orderstatus, sum(a)::BIGINT AS left_n, sum(b)::BIGINT AS right_n FROM u GROUP BY ALL),
k AS (SELECT o_custkey, sum(a)::BIGINT AS left_rows, sum(b)::BIGINT AS right_rows FROM u GROUP BY ALL)
SELECT c.*, left_rows, right_rows FROM c JOIN k ON c.o_custkey IS NOT DISTINCT FROM k.o_custkey WHERE left_n <> right_n""")
def q_reconcile_copies(spark, sf_dir):
    """Orders by customer, a key that repeats, against a copy that lost and changed some."""
    o, k = fx.table(spark, sf_dir, "orders"), F.col("o_orderkey")
    right = o.where(k % 11 != 0).withColumn("o_orderpriority", F.when(k % 13 != 0, F.col("o_orderpriority")))
    return reconcile.reconcile_copies(o, right, ["o_custkey"], ["o_orderpriority", "o_orderstatus"])


@register("diff_count", f"WITH {RECON_SQL} " + " UNION ALL ".join(
    [f"SELECT '{c}' AS column_name, CAST(count_if(status = 'changed' AND left_{c} IS DISTINCT FROM right_{c}) AS BIGINT) AS n_diff FROM recon"
     for c in RECON_COLS] +
    [f"SELECT '({s})' AS column_name, CAST(count_if(status = '{s}') AS BIGINT) AS n_diff FROM recon"
     for s in ("left_only", "right_only")]))
def q_diff_count(spark, sf_dir):
    return reconcile.diff_count(_recon(spark, sf_dir), RECON_COLS)


def _customer_versions(spark, sf_dir) -> str:
    c = fx.table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    name, path = _table_name("customer_versions"), scratch_path(spark, "customer_versions")
    snapshots.save_version(c, name, "WRITE OVERWRITE", location=path)
    snapshots.save_version(c.where(k % 9 != 0).withColumn(
        "c_acctbal", F.when(k % 4 == 0, F.col("c_acctbal") + 1).otherwise(F.col("c_acctbal"))), name, "WRITE OVERWRITE")
    snapshots.save_version(c.where(k % 5 == 0).withColumn("c_custkey", -(k + 1)), name, "WRITE APPEND", append=True)
    return name


@register("snapshot_scan", """
SELECT c_custkey, c_name, c_nationkey, CASE WHEN c_custkey % 4 = 0 THEN c_acctbal + 1 ELSE c_acctbal END AS c_acctbal,
  c_mktsegment FROM customer WHERE c_custkey % 9 <> 0""")
def q_snapshot_scan(spark, sf_dir):
    return snapshots.read_version(spark, _customer_versions(spark, sf_dir), 2)


@register("snapshot_deleted", "SELECT * FROM customer WHERE c_custkey % 9 = 0")
def q_snapshot_deleted(spark, sf_dir):
    """Customers of the first extract that the second lacks: two plain DataFrames."""
    old = fx.table(spark, sf_dir, "customer")
    new = old.where(F.col("c_custkey") % 9 != 0).withColumn("c_acctbal", F.col("c_acctbal") + 1)
    return snapshots.snapshot_deleted(old, new, ["c_custkey"])


@register("snapshot_history", """
SELECT CAST(1 AS BIGINT) AS version, 'WRITE OVERWRITE' AS operation, CAST(count(*) AS BIGINT) AS num_rows FROM customer
UNION ALL SELECT 2, 'WRITE OVERWRITE', count(*) FROM customer WHERE c_custkey % 9 <> 0
UNION ALL SELECT 3, 'WRITE APPEND', (SELECT count(*) FROM customer WHERE c_custkey % 9 <> 0)
  + (SELECT count(*) FROM customer WHERE c_custkey % 5 = 0)""")
def q_snapshot_history(spark, sf_dir):
    return snapshots.history(spark, _customer_versions(spark, sf_dir)).select("version", "operation", "num_rows")


# ================================================================= 2.9 labels and timing
def _label_sql(v: str, units) -> str:
    """``units``: (name, size in the smallest unit, how many make the next unit), smallest first."""
    parts = []
    for name, size, radix in units:
        q = f"(({v}) // {size} % {radix})" if radix else f"(({v}) // {size})"
        parts.append(f"CASE WHEN {q} > 0 THEN CAST({q} AS VARCHAR) || ' {name}' || "
                     f"CASE WHEN {q} > 1 THEN 's' ELSE '' END END")
    return f"concat_ws(' ', {', '.join(reversed(parts))})"


def _time_sql(seconds: str) -> str:
    return _label_sql(f"CAST(round({seconds} * 1000) AS BIGINT)", [
        ("millisecond", 1, 1000), ("second", 1000, 60), ("minute", 60000, 60), ("hour", 3600000, 24), ("day", 86400000, None)])


_TIMING = ("round(sum(value), 6) AS total_duration_s, round(avg(value), 6) AS avg_duration_s, "
           "count(*) AS total_files")


@register("timing_by_activity", f"""
SELECT *, {_time_sql('total_duration_s')} AS total_duration_time, {_time_sql('avg_duration_s')} AS avg_duration_time
FROM (SELECT event_type AS activity, {_TIMING} FROM events GROUP BY event_type)""")
def q_timing_by_activity(spark, sf_dir):
    ev = fx.table(spark, sf_dir, "events").withColumnRenamed("event_type", "activity")
    return timing_report(ev, ["activity"], duration_col="value")


@register("timing_total", f"""
SELECT *, {_time_sql('total_duration_s')} AS total_duration_time, {_time_sql('avg_duration_s')} AS avg_duration_time
FROM (SELECT {_TIMING} FROM events)""")
def q_timing_total(spark, sf_dir):
    return timing_report(fx.table(spark, sf_dir, "events"), [], duration_col="value")


@register("bytes_label", f"""
SELECT doc_id, n_chars * 1000003 AS bytes, {_label_sql('n_chars * 1000003', [
    ('byte', 1, 1024), ('kilobyte', 1024, 1024), ('megabyte', 1048576, 1024), ('gigabyte', 1073741824, None)])} AS label FROM documents""")
def q_bytes_label(spark, sf_dir):
    d = fx.table(spark, sf_dir, "documents")
    b = F.col("n_chars") * 1000003
    return d.select("doc_id", b.alias("bytes"), labels.bytes_label(b).alias("label"))


@register("time_label", f"""
SELECT o_orderkey, o_orderkey * 997 AS seconds, {_time_sql('o_orderkey * 997')} AS label FROM orders""")
def q_time_label(spark, sf_dir):
    s = F.col("o_orderkey") * 997
    return fx.table(spark, sf_dir, "orders").select("o_orderkey", s.alias("seconds"), labels.time_label(s).alias("label"))


@register("duration_seconds", """
SELECT event_id, (epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-01 00:00:00')) / 1e6 AS seconds FROM events""")
def q_duration_seconds(spark, sf_dir):
    start = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    return fx.table(spark, sf_dir, "events").select("event_id", labels.duration_seconds(start, F.col("ts")).alias("seconds"))


# ================================================================= 2.3 column transforms
@register("business_date_from_file", """
SELECT o_orderkey, file_name, replace(replace(file_name, 'orders_', ''), '.csv', '') AS BUSINESS_DATE
FROM (SELECT o_orderkey, 'orders_' || strftime(o_orderdate, '%Y.%m.%d') || '.csv' AS file_name FROM orders)""")
def q_business_date(spark, sf_dir):
    o = fx.table(spark, sf_dir, "orders").select(
        "o_orderkey", F.concat(F.lit("orders_"), F.date_format("o_orderdate", "yyyy.MM.dd"), F.lit(".csv")).alias("file_name"))
    return transforms.business_date_from_file(o, "file_name", "orders")


@register("add_source", "SELECT *, 'erp' AS SOURCE FROM orders")
def q_add_source(spark, sf_dir):
    return transforms.add_source(fx.table(spark, sf_dir, "orders"), "erp")


@register("convert_dates", """
SELECT o_orderkey, d_text, CAST(try_strptime(d_text, '%Y.%m.%d') AS DATE) AS d FROM (
  SELECT o_orderkey, CASE WHEN o_orderkey % 13 = 0 THEN strftime(o_orderdate, '%Y-%m-%d')
    ELSE strftime(o_orderdate, '%Y.%m.%d') END AS d_text FROM orders)""")
def q_convert_dates(spark, sf_dir):
    o = fx.table(spark, sf_dir, "orders")
    txt = F.when(F.col("o_orderkey") % 13 == 0, F.date_format("o_orderdate", "yyyy-MM-dd")) \
           .otherwise(F.date_format("o_orderdate", "yyyy.MM.dd"))
    return transforms.convert_dates(o.select("o_orderkey", txt.alias("d_text"), txt.alias("d")), ["d"])


@register("stamp_load_time", "SELECT o_orderkey, '2025-09-02 11:41' AS DATE_INSERT FROM orders")
def q_stamp_load_time(spark, sf_dir):
    return transforms.stamp_load_time(fx.table(spark, sf_dir, "orders").select("o_orderkey"), "DATE_INSERT",
                                      run_ts="2025-09-02 09:41:39", tz="Europe/Rome", fmt="yyyy-MM-dd HH:mm")


# ================================================================= 2.1 sources / 2.2 sinks
@register("delimited_read", "SELECT * FROM orders")
def q_delimited_read(spark, sf_dir):
    o = fx.table(spark, sf_dir, "orders")
    path = scratch_path(spark, "delimited_orders")
    o.write.options(delimiter="|", header=True, **fx.CSV_OPTIONS).csv(path)
    return delimited.delimited_read(spark, path, o.schema, delimiter="|", file_col=None, **fx.CSV_OPTIONS)


@register("delimited_read_untyped", """
SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey,
  CAST(c_acctbal AS VARCHAR) AS c_acctbal, c_mktsegment FROM customer""")
def q_delimited_read_untyped(spark, sf_dir):
    path = scratch_path(spark, "delimited_customer")
    fx.table(spark, sf_dir, "customer").write.options(delimiter=";", header=True).csv(path)
    return delimited.delimited_read_untyped(spark, path, delimiter=";")


def _orders_landing(spark, sf_dir, rows_per_file: int = 500_000) -> str:
    """Orders as files per status and key hash, so many that none holds more than about
    ``rows_per_file`` rows; each is written by one task."""
    folder = scratch_path(spark, "orders_landing")
    o = fx.table(spark, sf_dir, "orders")
    n = -(-o.count() // rows_per_file) or 1
    part = F.pmod(F.xxhash64("o_orderkey"), F.lit(n)).cast("string")
    fx.write_named_files(spark, o, F.concat(F.lit("orders_"), F.col("o_orderstatus"), F.lit("_"), part, F.lit(".csv")),
                         folder, options=fx.CSV_OPTIONS)
    return folder


@register("file_listing", """
SELECT 'orders_' || o_orderstatus || '_0.csv' AS name,
  (strlen('o_orderkey|o_custkey|o_orderstatus|o_totalprice|o_orderdate|o_orderpriority') + 1 +
   sum(strlen(concat_ws('|', o_orderkey, o_custkey, o_orderstatus, o_totalprice, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.%f'),
                        o_orderpriority)) + 1))::BIGINT AS size, true AS placed FROM orders GROUP BY o_orderstatus""")
def q_file_listing(spark, sf_dir):
    """The listing's names and sizes; of paths and times, that they fit."""
    found = listing.file_listing(spark, _orders_landing(spark, sf_dir))
    return found.select("name", "size", (F.col("path").endswith(F.col("name")) & (F.col("modificationTime") > 0)).alias("placed"))


@register("file_select", "SELECT * FROM orders WHERE o_orderstatus = 'O'")
def q_file_select(spark, sf_dir, rows_per_file: int = 500_000):
    folder = _orders_landing(spark, sf_dir, rows_per_file)
    chosen = listing.file_select(listing.file_listing(spark, folder, "orders_O_*.csv"), "multiple")
    paths = [r["path"] for r in chosen.select("path").collect()]       # one row per file
    schema = fx.table(spark, sf_dir, "orders").schema
    return delimited.delimited_read(spark, paths, schema, file_col=None, **fx.CSV_OPTIONS)


@register("table_scan", "SELECT * FROM orders")
def q_table_scan(spark, sf_dir):
    """Orders by the name of a catalog table over the given files."""
    name = _table_name("orders")
    spark.catalog.createTable(name, path=f"{sf_dir.rstrip('/')}/orders.parquet", source="parquet")
    return tables.table_scan(spark, name)


@register("append_write", "SELECT * FROM orders")
def q_append_write(spark, sf_dir):
    o, name, path = fx.table(spark, sf_dir, "orders"), _table_name("append"), scratch_path(spark, "append_orders")
    writes.append_write(o.where(F.col("o_orderstatus") == "F"), name, location=path)
    writes.append_write(o.where(F.col("o_orderstatus") != "F"), name, location=path)
    return tables.table_scan(spark, name)


@register("append_write_evolving", """
SELECT o_orderkey, CASE WHEN o_orderstatus = 'O' THEN o_custkey * 10000000000 ELSE o_custkey END AS o_custkey,
  CASE WHEN o_orderstatus = 'O' THEN o_orderkey % 1000 + 0.25 ELSE o_orderkey % 1000 END AS score,
  CASE WHEN o_orderstatus <> 'F' THEN o_orderpriority END AS o_orderpriority FROM orders""")
def q_append_write_evolving(spark, sf_dir):
    """Three appends to one named table: the second adds a column, the third brings values
    that the types of two columns do not hold."""
    o, name, path = fx.table(spark, sf_dir, "orders"), _table_name("evolving"), scratch_path(spark, "evolving_orders")
    score = (F.col("o_orderkey") % 1000)
    of = lambda test, key, value, *more: o.where(test).select("o_orderkey", key.alias("o_custkey"), value.alias("score"), *more)
    status, cust = F.col("o_orderstatus"), F.col("o_custkey")
    writes.append_write(of(status == "F", cust.cast("int"), score.cast("int")), name, location=path)
    writes.append_write(of(~status.isin("F", "O"), cust.cast("int"), score.cast("smallint"), "o_orderpriority"), name)
    writes.append_write(of(status == "O", cust * 10000000000, score + F.lit(0.25).cast("double"), "o_orderpriority"), name)
    return tables.table_scan(spark, name)


@register("overwrite_write", "SELECT * FROM orders WHERE o_orderpriority = '1-URGENT'")
def q_overwrite_write(spark, sf_dir):
    o, name, path = fx.table(spark, sf_dir, "orders"), _table_name("overwrite"), scratch_path(spark, "overwrite_orders")
    writes.overwrite_write(o, name, location=path)
    writes.overwrite_write(o.where(F.col("o_orderpriority") == "1-URGENT"), name, location=path)
    return tables.table_scan(spark, name)


@register("schema_evolve", """
SELECT * REPLACE (CASE WHEN o_orderstatus = 'F' THEN NULL ELSE o_orderpriority END AS o_orderpriority) FROM orders""")
def q_schema_evolve(spark, sf_dir):
    o, path = fx.table(spark, sf_dir, "orders"), scratch_path(spark, "evolve_orders")
    writes.append_write(o.where(F.col("o_orderstatus") == "F").drop("o_orderpriority"), path)
    writes.append_write(o.where(F.col("o_orderstatus") != "F"), path)
    return writes.read_evolved(spark, path)


# ================================================================= 2.11 composed plans, 2.12 streaming
_ev_sel_b = ", ".join(EV_COLS)
BRONZE_SQL = f"""{EV_RAW},
b AS (SELECT {_ev_sel_b}, file_idx, file_name FROM ev
      QUALIFY row_number() OVER (PARTITION BY file_name, user_id ORDER BY event_id DESC) = 1)"""


def events_bronze_hook(df, file_name, sub_entity, source):
    """The entity's hook; the parts of a period's file have the period's business date."""
    return hooks.source_and_business_date(df, F.regexp_replace(file_name, "_p[0-9]+[.]csv$", ".csv"), sub_entity, source)


def _bronze_schema():
    from pyspark.sql.types import StringType, StructField, StructType
    return StructType([*fx.EVENTS_RAW_SCHEMA.fields, StructField("SOURCE", StringType()),
                       StructField("BUSINESS_DATE", StringType())])


def _events_bronze(spark, sf_dir, *, hook: bool = False, write_mode: str = "append"):
    base = scratch_path(spark, "events_ingest")
    landing = fx.events_landing(spark, sf_dir, f"{base}/landing")
    bronze = _layer(spark, base, "bronze", keys=["user_id"] if write_mode == "merge" else [])
    kw = dict(bronze_func=events_bronze_hook, f_args=("events", "erp"), bronze_schema=_bronze_schema()) if hook else {}
    res = ingest.raw_to_bronze(spark, landing, fx.EVENTS_RAW_SCHEMA, bronze, ["user_id"], seq="event_id",
                               op_col="op", read_options=fx.CSV_OPTIONS, move=True, write_mode=write_mode, **kw)
    return bronze, res, base


@register("raw_to_bronze", f"WITH {BRONZE_SQL} SELECT {_ev_sel_b} FROM b")
def q_raw_to_bronze(spark, sf_dir):
    return _events_bronze(spark, sf_dir)[0].read()


@register("layer_transform", f"""WITH {BRONZE_SQL}
SELECT {_ev_sel_b}, 'erp' AS SOURCE, replace(replace(file_name, 'events_', ''), '.csv', '') AS BUSINESS_DATE FROM b""")
def q_layer_transform(spark, sf_dir):
    return _events_bronze(spark, sf_dir, hook=True)[0].read()


def _merge_files_in_order_sql() -> str:
    """The five landing files merged one after another (file 0 first) into an empty
    table: five full outer joins with the merge rule of ``merge_ops``."""
    pick = ", ".join(f"CASE WHEN s._s IS NOT NULL AND (t._t IS NULL OR s.op IS NOT DISTINCT FROM 'I' OR s.op IS NULL) "
                     f"THEN s.{c} ELSE t.{c} END AS {c}" for c in EV_COLS)
    steps = [f"m0 AS (SELECT {_ev_sel_b}, true AS _t FROM b WHERE false)"]
    for i in range(5):
        steps.append(f"m{i + 1} AS (SELECT {pick}, true AS _t FROM m{i} AS t FULL OUTER JOIN "
                     f"(SELECT {_ev_sel_b}, true AS _s FROM b WHERE file_idx = {i}) AS s ON t.user_id = s.user_id "
                     f"WHERE NOT (s._s IS NOT NULL AND s.op IS NOT DISTINCT FROM 'D'))")
    return f"WITH {BRONZE_SQL}, " + ", ".join(steps) + f" SELECT {_ev_sel_b} FROM m5"


@register("raw_to_bronze_merge", _merge_files_in_order_sql())
def q_raw_to_bronze_merge(spark, sf_dir):
    """Merge-mode bronze over all five files in one plan (``fold_changes``): equal to
    merging the files one after another, ops I / D / U / null included."""
    return _events_bronze(spark, sf_dir, write_mode="merge")[0].read()


_LOG_COUNTS = ["n_read", "n_rejected", "n_inserted", "n_updated", "n_deleted", "n_left"]


@register("step_log", f"""WITH {BRONZE_SQL},
files AS (SELECT file_name, count(*) AS n_read FROM ev GROUP BY file_name),
written AS (SELECT file_name, count(*) AS n FROM b GROUP BY file_name)
SELECT activity, file_name, CASE WHEN activity = 'read' THEN n_read END AS n_read,
  CASE WHEN activity = 'data_quality' THEN 0 END AS n_rejected, CASE WHEN activity = 'write' THEN n END AS n_inserted,
  {', '.join(f"CASE WHEN activity = 'write' THEN 0 END AS {c}" for c in _LOG_COUNTS[3:])}, true AS in_order
FROM files JOIN written USING (file_name), (VALUES ('read'), ('data_quality'), ('write'), ('archive')) AS acts(activity)""")
def q_step_log(spark, sf_dir):
    """The log of a run: activities, files and row counts; of the times, that they are in order."""
    log = _events_bronze(spark, sf_dir)[1].log
    return log.select("activity", "file_name", *_LOG_COUNTS, ((F.col("start_time") <= F.col("end_time")) & (F.col("file_size") > 0)).alias("in_order"))


@register("bronze_to_silver", f"""WITH {BRONZE_SQL}
SELECT {_ev_sel_b} FROM b QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1
  AND op IS DISTINCT FROM 'D'""")
def q_bronze_to_silver(spark, sf_dir):
    bronze, _, base = _events_bronze(spark, sf_dir)
    silver = _layer(spark, base, "silver", keys=["user_id"])
    ingest.bronze_to_silver(spark, bronze, silver, ["user_id"], seq="event_id", op_col="op")
    return silver.read()


events_silver_hook = hooks.dates_and_update_time


@register("layer_transform_silver", f"""WITH {BRONZE_SQL}
SELECT {_ev_sel_b}, 'erp' AS SOURCE,
  CAST(try_strptime(replace(replace(file_name, 'events_', ''), '.csv', ''), '%Y.%m.%d') AS DATE) AS BUSINESS_DATE,
  TIMESTAMP '2025-09-02 09:41:39' AS UpdateTimestamp
FROM b QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1 AND op IS DISTINCT FROM 'D'""")
def q_layer_transform_silver(spark, sf_dir):
    bronze, _, base = _events_bronze(spark, sf_dir, hook=True)
    silver = _layer(spark, base, "silver", keys=["user_id"])
    ingest.bronze_to_silver(spark, bronze, silver, ["user_id"], seq="event_id", op_col="op",
                            silver_func=events_silver_hook, f_args=(["BUSINESS_DATE"],),
                            f_kwargs={"run_ts": "2025-09-02 09:41:39"})
    return silver.read()


_ev_pick_b = ", ".join(f"CASE WHEN s._s IS NOT NULL AND (t._t IS NULL OR s.op IS NOT DISTINCT FROM 'I' OR s.op IS NULL) "
                       f"THEN s.{c} ELSE t.{c} END AS {c}" for c in EV_COLS)


RAW_TO_SILVER_SQL = f"""WITH {BRONZE_SQL},
t AS (SELECT {_ev_sel_b}, true AS _t FROM b WHERE file_idx < 3
      QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1 AND op IS DISTINCT FROM 'D'),
s AS (SELECT {_ev_sel_b}, true AS _s FROM b QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1)
SELECT {_ev_pick_b} FROM t FULL OUTER JOIN s ON t.user_id = s.user_id
WHERE NOT (s._s IS NOT NULL AND s.op IS NOT DISTINCT FROM 'D')"""


@register("raw_to_silver", RAW_TO_SILVER_SQL)
def q_raw_to_silver(spark, sf_dir):
    from keyfold.spec import EntitySpec
    spec = EntitySpec("analytics", "web", "fact", "app", "events", "delta", "events",
                      primary_keys=("user_id",), raw_schema=fx.EVENTS_RAW_SCHEMA, sequence_column="event_id",
                      operation_column="op", read_options=fx.CSV_OPTIONS)
    base = scratch_path(spark, "events_layers")
    landing = f"{base}/landing"
    bronze = _layer(spark, base, "bronze")
    silver = _layer(spark, base, "silver", keys=["user_id"])
    fx.events_landing(spark, sf_dir, landing, files=(0, 1, 2))
    ingest.raw_to_silver(spark, spec, landing, bronze, silver, move=True)
    fx.events_landing(spark, sf_dir, landing, files=(3, 4))
    ingest.raw_to_silver(spark, spec, landing, bronze, silver, move=True)
    return silver.read()


@register("new_bronze_to_silver", RAW_TO_SILVER_SQL)
def q_new_bronze_to_silver(spark, sf_dir):
    """Two runs of the ingest, each followed by silver from the new loads only."""
    base = scratch_path(spark, "events_new")
    bronze, silver = _layer(spark, base, "bronze"), _layer(spark, base, "silver", keys=["user_id"])
    for files in ((0, 1, 2), (3, 4)):
        fx.events_landing(spark, sf_dir, f"{base}/landing", files=files)
        ingest.raw_to_bronze(spark, f"{base}/landing", fx.EVENTS_RAW_SCHEMA, bronze, ["user_id"], seq="event_id",
                             read_options=fx.CSV_OPTIONS, move=True)
        ingest.new_bronze_to_silver(spark, bronze, silver, ["user_id"], seq="event_id", op_col="op")
    return silver.read()


def _events_stream(spark, sf_dir, *, by_period: bool = False, **options):
    """``by_period``: a micro-batch takes as many files as a period has, which land one
    behind another, so the number of micro-batches does not grow with the files."""
    if by_period:
        options["max_files"] = fx.events_parts(spark, sf_dir)
    base = scratch_path(spark, "events_stream")
    landing = fx.events_landing(spark, sf_dir, f"{base}/landing")
    bronze = _layer(spark, base, "bronze", keys=["user_id"] if options.get("write_mode") == "merge" else [])
    stream = FileStream(spark, landing, fx.EVENTS_RAW_SCHEMA, bronze, ["user_id"], f"{base}/_checkpoint",
                        seq="event_id", read_options=fx.CSV_OPTIONS, **options)
    stream.run()
    return bronze, stream


@register("stream_raw_to_bronze", f"WITH {BRONZE_SQL} SELECT {_ev_sel_b} FROM b")
def q_stream_raw_to_bronze(spark, sf_dir):
    return _events_stream(spark, sf_dir)[0].read()


@register("stream_raw_to_bronze_merge", _merge_files_in_order_sql())
def q_stream_raw_to_bronze_merge(spark, sf_dir):
    """Merge-mode bronze fed by the file stream, one period's landing file, with all its
    parts, per micro-batch (files in landing order): each micro-batch is one merge, as in the oracle."""
    return _events_stream(spark, sf_dir, op_col="op", write_mode="merge", by_period=True)[0].read()


@register("stream_archive", f"""WITH {EV_RAW}
SELECT file_name, 'accept' AS action, true AS archived FROM ev GROUP BY file_name""")
def q_stream_archive(spark, sf_dir):
    """Where the stream's files are in the end: archived by the source, the last batch's by
    ``settle``. The archive keeps each file's path below it."""
    bronze, stream = _events_stream(spark, sf_dir, clean_source="archive", by_period=True, archive_dir=scratch_path(spark, "archive"))
    kept = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(stream.archive_dir)
            .select(F.element_at(F.split("path", "/"), -1).alias("file_name")))
    done = bronze.done_files().select(F.col("name").alias("file_name"), "action")
    left = listing.file_listing(spark, stream.landing).select(F.col("name").alias("file_name"))
    return (done.join(kept.withColumn("archived", F.lit(True)), "file_name", "left").join(left, "file_name", "left_anti")
            .select("file_name", "action", F.coalesce("archived", F.lit(False)).alias("archived")))


# ================================================================= fiscal code
_ALPH = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"
PEOPLE_SQL = """people AS (SELECT p_partkey, string_split(p_name, ' ')[1] AS surname, string_split(p_name, ' ')[2] AS name,
  CAST(1940 + p_partkey % 70 AS VARCHAR) AS year, CAST(p_partkey % 12 + 1 AS VARCHAR) AS month,
  CAST(p_partkey % 28 + 1 AS VARCHAR) AS day, CASE WHEN p_partkey % 2 = 0 THEN 'M' ELSE 'f' END AS gender,
  CASE WHEN p_partkey % 50 = 7 THEN 'atlantis' ELSE lower(n_name) END AS town
  FROM part JOIN nation ON n_nationkey = p_partkey % 25),
towns AS (SELECT 'A' || lpad(CAST(n_nationkey AS VARCHAR), 3, '0') AS town_code, n_name AS town_name FROM nation)"""


TOWNS_FILE_SQL = """towns_file AS (
  SELECT 'A' || lpad(CAST(n_nationkey AS VARCHAR), 3, '0') AS town_code, n_name AS town_name FROM nation
  UNION ALL SELECT 'S' || lpad(CAST(s_suppkey AS VARCHAR), 7, '0'), s_name FROM supplier)"""  # the town lookup files


def _name_sql(s: str, first: bool) -> str:
    cons = f"regexp_replace(upper({s}), '[^BCDFGHJKLMNPQRSTVWXYZ]', '', 'g')"
    vow = f"regexp_replace(upper({s}), '[^AEIOU]', '', 'g')"
    plain = f"substr({cons} || {vow} || 'XX', 1, 3)"
    if not first:
        return plain
    return (f"CASE WHEN length({cons}) > 3 THEN substr({cons}, 1, 1) || substr({cons}, 3, 1) || substr({cons}, 4, 1) "
            f"ELSE {plain} END")


_M, _D = "TRY_CAST(month AS INTEGER)", "TRY_CAST(day AS INTEGER)"
BIRTH_SQL = (f"substr(year, 3) || CASE WHEN {_M} BETWEEN 1 AND 12 THEN substr('ABCDEHLMPRST', {_M}, 1) END || "
             f"CASE WHEN upper(gender) = 'M' THEN lpad(CAST({_D} AS VARCHAR), 2, '0') ELSE CAST({_D} + 40 AS VARCHAR) END")


def _check_sql(c: str) -> str:
    # the published values, 0 to 9 and A to Z, written out again: the oracle shares no table with the function
    odd = "[1,0,5,7,9,13,15,17,19,21, 1,0,5,7,9,13,15,17,19,21,2,4,18,20,11,3,6,8,12,14,16,10,22,25,24,23]"
    even = "[0,1,2,3,4,5,6,7,8,9, 0,1,2,3,4,5,6,7,8,9,10,11,12,13,14,15,16,17,18,19,20,21,22,23,24,25]"
    pos = f"strpos('{_ALPH}', substr({c}, i, 1))"
    total = (f"list_sum(list_transform(range(1, 16), lambda i: coalesce(CASE WHEN i % 2 = 1 THEN {odd}[{pos}] "
             f"ELSE {even}[{pos}] END, 0)))")
    return f"CASE WHEN length({c}) = 15 THEN chr(CAST(65 + {total} % 26 AS INTEGER)) END"


CODES_SQL = f"""{PEOPLE_SQL},
j AS (SELECT people.*, towns.town_code, towns.town_name IS NOT NULL AS town_found
      FROM people LEFT JOIN towns ON upper(people.town) = upper(towns.town_name)),
b AS (SELECT *, {_name_sql('surname', False)} || {_name_sql('name', True)} || {BIRTH_SQL} || town_code AS code15 FROM j),
codes AS (SELECT * EXCLUDE (code15), code15 || {_check_sql('code15')} AS fiscal_code FROM b)"""


def _people(spark, sf_dir):
    return fx.people(spark, sf_dir)


def _towns(spark, sf_dir):
    n = fx.table(spark, sf_dir, "nation")
    return n.select(fx.town_code(F.col("n_nationkey")).alias("town_code"), F.col("n_name").alias("town_name"))


@register("name_code", f"""WITH {PEOPLE_SQL}
SELECT p_partkey, {_name_sql('surname', False)} AS surname_code, {_name_sql('name', True)} AS name_code FROM people""")
def q_name_code(spark, sf_dir):
    return _people(spark, sf_dir).select("p_partkey", fiscal.name_code(F.col("surname"), first_name=False).alias("surname_code"),
                                         fiscal.name_code(F.col("name")).alias("name_code"))


@register("birth_code", f"WITH {PEOPLE_SQL} SELECT p_partkey, {BIRTH_SQL} AS birth_code FROM people")
def q_birth_code(spark, sf_dir):
    return _people(spark, sf_dir).select("p_partkey", fiscal.birth_code("year", "month", "day", "gender").alias("birth_code"))


@register("check_char", f"""WITH {PEOPLE_SQL},
j AS (SELECT people.*, towns.town_code FROM people LEFT JOIN towns ON upper(people.town) = upper(towns.town_name)),
b AS (SELECT p_partkey, {_name_sql('surname', False)} || {_name_sql('name', True)} || {BIRTH_SQL} || town_code AS code15 FROM j)
SELECT p_partkey, code15, {_check_sql('code15')} AS check_char FROM b""")
def q_check_char(spark, sf_dir):
    j = fiscal.town_lookup(_people(spark, sf_dir), _towns(spark, sf_dir))
    code15 = F.concat(fiscal.name_code(F.col("surname"), first_name=False), fiscal.name_code(F.col("name")),
                      fiscal.birth_code("year", "month", "day", "gender"), F.col("town_code"))
    return j.select("p_partkey", code15.alias("code15")).withColumn("check_char", fiscal.check_char("code15"))


@register("fiscal_code", f"WITH {CODES_SQL} SELECT * FROM codes")
def q_fiscal_code(spark, sf_dir):
    return fiscal.fiscal_code(_people(spark, sf_dir), _towns(spark, sf_dir))


@register("town_lookup", f"""WITH {PEOPLE_SQL}, {TOWNS_FILE_SQL}
SELECT p_partkey, town, towns_file.town_code, towns_file.town_name IS NOT NULL AS town_found
FROM people LEFT JOIN towns_file ON upper(people.town) = upper(towns_file.town_name)""")
def q_town_lookup(spark, sf_dir):
    path = fx.write_town_file(spark, sf_dir, scratch_path(spark, "towns"))
    towns = lookup.lookup_load(spark, path, sep=";", header_lines=2, cols=[0, 2], names=["town_code", "town_name"])
    return fiscal.town_lookup(_people(spark, sf_dir).select("p_partkey", "town"), towns)


@register("lookup_load", f"WITH {TOWNS_FILE_SQL} SELECT town_code, town_name FROM towns_file")
def q_lookup_load(spark, sf_dir):
    path = fx.write_town_file(spark, sf_dir, scratch_path(spark, "towns"))
    return lookup.lookup_load(spark, path, sep=";", header_lines=2, cols=[0, 2], names=["town_code", "town_name"])


@register("lookup_unpivot", f"WITH {TOWNS_FILE_SQL} SELECT town_name, town_code FROM towns_file")
def q_lookup_unpivot(spark, sf_dir):
    path = fx.write_wide_town_file(spark, sf_dir, scratch_path(spark, "towns_wide"))
    wide = lookup.lookup_load(spark, path, sep="\t", header_lines=1, cols=list(range(8)))
    return lookup.lookup_unpivot(wide, 4, key="town_name", value="town_code")


def _plain_sql(c: str) -> str:
    return f"coalesce({c} <> '' AND regexp_replace({c}, '[A-Za-z''\\s]', '', 'g') = '', false)"


@register("person_validate", f"""WITH {PEOPLE_SQL},
f AS (SELECT *,
  {_plain_sql('surname')} AS surname_ok,
  {_plain_sql('name')} AS name_ok,
  coalesce(regexp_matches(year, '^[0-9]{{4}}$') AND TRY_CAST(year AS INT) BETWEEN 1800 AND 2022, false) AS year_ok,
  coalesce(regexp_matches(month, '^[0-9]{{1,2}}$') AND TRY_CAST(month AS INT) BETWEEN 1 AND 12, false) AS month_ok,
  coalesce(regexp_matches(day, '^[0-9]{{1,2}}$') AND TRY_CAST(day AS INT) BETWEEN 1 AND 31, false) AS day_ok,
  coalesce(gender IN ('M', 'F', 'm', 'f'), false) AS gender_ok,
  {_plain_sql('town')} AS town_ok,
  try_cast(make_date(TRY_CAST(year AS BIGINT), TRY_CAST(month AS BIGINT), TRY_CAST(day AS BIGINT)) AS DATE) IS NOT NULL AS date_valid
  FROM people)
SELECT *, surname_ok AND name_ok AND year_ok AND month_ok AND day_ok AND gender_ok AND town_ok AND date_valid AS valid FROM f""")
def q_person_validate(spark, sf_dir):
    return fiscal.person_validate(_people(spark, sf_dir))


REGISTER_SQL = f"""WITH {CODES_SQL},
reg AS (SELECT upper(surname) AS Surname, upper(name) AS Name, upper(year) AS Year, upper(month) AS Month,
  upper(day) AS Day, upper(gender) AS Gender, upper(town) AS Town, upper(fiscal_code) AS Fiscal_code FROM codes)"""


def _register(spark, sf_dir):
    codes = fiscal.fiscal_code(_people(spark, sf_dir), _towns(spark, sf_dir))
    out = codes.select(*[F.col(c).alias(n) for c, n in (
        ("surname", "Surname"), ("name", "Name"), ("year", "Year"), ("month", "Month"), ("day", "Day"),
        ("gender", "Gender"), ("town", "Town"), ("fiscal_code", "Fiscal_code"))])
    path = scratch_path(spark, "code_register")
    writes.code_register_write(out, path)
    return delimited.delimited_read_untyped(spark, path, delimiter=";")


@register("code_register_write", f"{REGISTER_SQL} SELECT * FROM reg")
def q_code_register_write(spark, sf_dir):
    return _register(spark, sf_dir)


@register("code_search", f"{REGISTER_SQL} SELECT * FROM reg WHERE Gender = upper('f')")
def q_code_search(spark, sf_dir):
    return fiscal.code_search(_register(spark, sf_dir), "Gender", "f")
