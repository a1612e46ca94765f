import re

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from keyfold.functions import labels

UNITS = {"byte": 1, "kilobyte": 1024, "megabyte": 1024 ** 2, "gigabyte": 1024 ** 3}


def _bytes(spark, vals):
    df = spark.createDataFrame([(v,) for v in vals], "v long")
    return [r.l for r in df.select(labels.bytes_label("v").alias("l")).collect()]


def test_bytes_examples(spark):
    assert _bytes(spark, [0, 1, 2, 1023, 1024, 7278420621, 3 * 1024 ** 4]) == [
        "", "1 byte", "2 bytes", "1023 bytes", "1 kilobyte",
        "6 gigabytes 797 megabytes 248 kilobytes 653 bytes", "3072 gigabytes"]


def test_time_examples(spark):
    df = spark.createDataFrame([(61.0,), (500000.0,), (0.25,)], "s double")
    got = [r.l for r in df.select(labels.time_label("s").alias("l")).collect()]
    assert got == ["1 minute 1 second", "5 days 18 hours 53 minutes 20 seconds", "250 milliseconds"]


def test_duration_seconds(spark):
    df = spark.createDataFrame([("2024-01-01 00:00:00", "2024-01-01 00:01:01.5")], "a string, b string")
    df = df.select(F.col("a").cast("timestamp"), F.col("b").cast("timestamp"))
    assert df.select(labels.duration_seconds("a", "b").alias("d")).first().d == 61.5


@settings(max_examples=25, deadline=None)
@given(st.lists(st.integers(min_value=0, max_value=2 ** 62), min_size=1, max_size=20))
def test_label_parses_back(spark, vals):
    for v, label in zip(vals, _bytes(spark, vals)):
        total = sum(int(n) * UNITS[u] for n, u in re.findall(r"(\d+) (\w+?)s?(?= |$)", label))
        assert total == v
