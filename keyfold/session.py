"""Session helpers: a tuned builder for tests and benches, and the shared work folder.

Scratch output (fixture files, snapshot tables written by the registered
queries, checkpoints) always goes below the folder the cluster names in
``spark.checkpoint.dir``; a local folder is only set when that is unset,
as in tests.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession


def get_spark(master: str | None = None, app: str = "keyfold",
              shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Session with AQE (coalesce + skew join), UTC session time, UI off."""
    master = master or os.environ.get("KEYFOLD_MASTER", "local[*]")
    b = (SparkSession.builder.master(master).appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.driver.memory", os.environ.get("KEYFOLD_DRIVER_MEMORY", "8g"))
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions or 8)))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    shared_dir(spark)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``; set a local one only if unset."""
    d = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: the server owns the context
        sc = None
    if not d and sc is not None:
        d = sc.getCheckpointDir()
    if not d and (sc is None or not re.match(r"local(\[|$)", sc.master)):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not d:
        d = tempfile.mkdtemp(prefix="keyfold-shared-")
        spark.conf.set("spark.checkpoint.dir", d)
    if sc is not None and not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    return d.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused folder below the shared folder."""
    return f"{shared_dir(spark)}/keyfold/{name}-{uuid.uuid4().hex[:12]}"
