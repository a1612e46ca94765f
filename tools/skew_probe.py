"""Hot-key probe: one key holds a third of all rows. Runs the keyed operators with
Spark's event log on and prints the shuffle records each stage wrote, which shows
whether the hot key was reduced before the shuffle.

usage: python tools/skew_probe.py <scratch folder, new and local> [rows]
"""

from __future__ import annotations

import glob
import io
import json
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def run(scratch: str, n: int) -> None:
    from pyspark.sql import functions as F

    from keyfold.operators import dedupe, quality, reconcile
    from keyfold.operators.snapshots import snapshot_deleted
    from keyfold.session import get_spark
    os.makedirs(f"{scratch}/events")
    spark = get_spark("local[8]", shuffle_partitions=16, extra={
        "spark.eventLog.enabled": "true", "spark.eventLog.dir": f"file://{scratch}/events",
        "spark.sql.autoBroadcastJoinThreshold": "-1"})
    base = spark.range(0, n, 1, 8).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"),
        F.col("id").alias("seq"), (F.col("id") % 20).cast("string").alias("file_name"))
    base.write.parquet(f"{scratch}/hot.parquet")
    df = spark.read.parquet(f"{scratch}/hot.parquet")
    runs = {
        "latest_per_key": lambda: dedupe.latest_per_key(df, ["k"], "seq"),
        "dq_check": lambda: quality.dq_check(df, ["k"], "seq"),
        "dup_keys": lambda: dedupe.dup_keys(df, ["k"]),
        "reconcile": lambda: reconcile.reconcile(df, df.where(F.col("seq") % 7 != 0), ["k"], ["seq"]),
        "snapshot_deleted": lambda: snapshot_deleted(df, df.where(F.col("seq") % 7 != 0), ["k"]),
    }
    for name, fn in runs.items():
        spark.sparkContext.setJobGroup(name, name)
        fn().write.format("noop").mode("overwrite").save()
    spark.stop()


def report(scratch: str) -> dict[str, list[int]]:
    import zstandard
    d = glob.glob(f"{scratch}/events/eventlog_v2_*")[0]
    stage_job, res = {}, {}
    for f in sorted(glob.glob(f"{d}/events_*")):
        raw = zstandard.ZstdDecompressor().stream_reader(open(f, "rb")) if f.endswith(".zstd") else open(f, "rb")
        for line in io.TextIOWrapper(raw, encoding="utf-8"):
            e = json.loads(line)
            ev = e.get("Event")
            if ev == "SparkListenerJobStart":
                g = (e.get("Properties") or {}).get("spark.jobGroup.id")
                for sid in e.get("Stage IDs", []):
                    stage_job[sid] = g
            elif ev == "SparkListenerStageCompleted":
                info = e["Stage Info"]
                g = stage_job.get(info["Stage ID"])
                for acc in info.get("Accumulables", []):
                    if acc.get("Name") == "internal.metrics.shuffle.write.recordsWritten" and g:
                        res.setdefault(g, []).append(int(acc["Value"]))
    return res


if __name__ == "__main__":
    scratch, n = sys.argv[1], int(sys.argv[2]) if len(sys.argv) > 2 else 600_000
    run(scratch, n)
    print(f"input rows {n}, hot key rows {len(range(0, n, 3))}")
    for g, v in report(scratch).items():
        print(f"{g:18s} shuffle records written per stage: {v}")
