"""Plan properties that matter at scale."""

import re
import sys

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_table_scan_pushes_filter_and_prunes_columns(spark):
    scanned = entry.queries()["table_scan"](spark, SF)      # a named table, whole
    p = _plan(scanned.where("o_totalprice > 250000").select("o_orderkey", "o_custkey", "o_totalprice"))
    assert "PushedFilters: [IsNotNull(o_totalprice), GreaterThan(o_totalprice,250000.0)]" in p
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_totalprice:double>" in p


def test_file_listing_never_reads_content(spark):
    from keyfold.sources.listing import file_listing
    p = _plan(file_listing(spark, f"{SF}", "*.parquet"))
    assert "content" not in p.split("ReadSchema")[-1].split("\n")[0]


def test_verdict_join_is_broadcast(spark):
    p = _plan(entry.queries()["verdict_join"](spark, SF))
    assert "BroadcastHashJoin" in p and "LeftSemi" in p


def test_fiscal_code_has_no_python(spark):
    p = _plan(entry.queries()["fiscal_code"](spark, SF))
    assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p


def _exchange_inputs(plan: str) -> list[str]:
    """For each hash exchange, the name of the operator just below it."""
    lines = plan.split("\n")
    out = []
    for i, line in enumerate(lines):
        if "Exchange hashpartitioning" in line and i + 1 < len(lines):
            below = re.sub(r"^\*\(\d+\) ", "", lines[i + 1].strip(" :+-"))   # codegen stage marker
            out.append(below.split(" ")[0].split("(")[0])
    return out


def test_keyed_merge_checks_one_row_per_key_map_side_without_an_extra_exchange(spark):
    from pyspark.sql import functions as F
    from keyfold.operators import merge
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        from keyfold import fixtures as fx
        t, s = fx.cdc_target(spark, SF), fx.cdc_source(spark, SF)
        p = _plan(merge.merge_ops(t, s, ["o_orderkey"], "op", strategy="shuffle"))
        # one exchange per side; the change set's is fed by a partial aggregate (map-side),
        # and the join sorts only the target (the final aggregate's output is already sorted)
        assert p.count("Exchange hashpartitioning") == 2
        assert any("Aggregate" in x for x in _exchange_inputs(p))
        # sorts: the target's, and the partial and final aggregate's; none of its own for the join
        assert p.split("SortMergeJoin")[1].count("Sort [o_orderkey") == 3
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_reconcile_and_snapshot_deleted_reduce_keys_before_the_shuffle(spark):
    from pyspark.sql import functions as F
    from keyfold.operators import reconcile
    from keyfold.operators.snapshots import snapshot_deleted
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        a = spark.range(1000).select((F.col("id") % 50).alias("k"), F.col("id").alias("v"))
        b = spark.range(900).select((F.col("id") % 50).alias("k"), F.col("id").alias("v"))
        p = _plan(reconcile.reconcile(a, b, ["k"]))
        assert p.count("Exchange hashpartitioning") == 2
        assert all("Aggregate" in x for x in _exchange_inputs(p))
        p = _plan(snapshot_deleted(a, b, ["k"]))
        assert p.count("BroadcastExchange") == 1 and "Exchange hashpartitioning" not in p   # proven small
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_verdict_join_beyond_the_bound_is_not_broadcast(spark):
    from keyfold.operators import quality, sizing
    rows_df = spark.createDataFrame([("f1", 1), ("f2", 2)], "file_name string, v int")
    verdicts = spark.createDataFrame([("f1", "accept"), ("f2", "reject")], "file_name string, action string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        p = _plan(quality.verdict_join(rows_df, verdicts, n_files=sizing.SMALL_MAX_ROWS + 1))
        assert "BroadcastHashJoin" not in p and "BroadcastExchange" not in p
        p = _plan(quality.verdict_join(rows_df, verdicts, n_files=2))
        assert "BroadcastHashJoin" in p
        assert [r.v for r in quality.verdict_join(rows_df, verdicts, n_files=sizing.SMALL_MAX_ROWS + 1).collect()] == [1]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")



def test_merges_scan_each_side_once(spark):
    """The change set is written once and read from there; the target is read once whole, and
    in the broadcast plan once more for its keys alone."""
    from keyfold.operators import merge
    t, s = spark.read.parquet(f"{SF}/orders.parquet"), spark.read.parquet(f"{SF}/orders.parquet").limit(50).withColumn("o_custkey", -_col("o_custkey"))
    small = merge.merge_upsert(t, s, ["o_orderkey"])
    plan = small._jdf.queryExecution().executedPlan().toString()
    reads = [line for line in plan.split("\n") if "FileScan parquet" in line]
    assert len(reads) == 2 and sum("ReadSchema: struct<o_orderkey:bigint>" in line for line in reads) == 1
    large = merge.merge_upsert(t, s, ["o_orderkey"], broadcast_max_rows=1)
    assert large._jdf.queryExecution().executedPlan().toString().count("FileScan parquet") == 2       # null keys bypass the join
    assert sorted(map(str, small.collect())) == sorted(map(str, large.collect()))


def test_current_state_reads_events_twice_and_joins_in_place(spark):
    df = entry.queries()["current_state"](spark, SF)
    plan = _plan(df)
    assert plan.count("FileScan parquet") <= 4 and "BroadcastExchange" not in plan


def _col(name):
    from pyspark.sql import functions as F
    return F.col(name)
