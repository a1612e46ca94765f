import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from keyfold.functions import transforms


def test_convert_dates(spark):
    df = spark.createDataFrame([("2024.01.02",), ("2024-01-02",), ("2024.13.02",), (None,)], "d string")
    got = [r.d for r in transforms.convert_dates(df, ["d"]).collect()]
    assert got == [dt.date(2024, 1, 2), None, None, None]
    assert df.agg(transforms.date_failures(df, ["d"]).alias("n")).first().n == 2


def test_business_date_and_source(spark):
    df = spark.createDataFrame([("COPA_2025.09.02.csv",)], "f string")
    out = transforms.add_source(transforms.business_date_from_file(df, "f", "COPA"), "sap").first()
    assert (out.BUSINESS_DATE, out.SOURCE) == ("2025.09.02", "sap")


def test_stamp_fixed_time_in_zone(spark):
    df = spark.range(1)
    out = transforms.stamp_load_time(df, "DATE_INSERT", run_ts="2025-01-15 09:41:00", tz="Europe/Rome",
                                     fmt="yyyy-MM-dd HH:mm").first()
    assert out.DATE_INSERT == "2025-01-15 10:41"


def test_check_schema(spark):
    df = spark.createDataFrame([("a", 1)], "x string, y int")
    want = StructType([StructField("x", StringType()), StructField("y", StringType())])
    assert transforms.schema_diff(df, want) == ["column y: int instead of string"]
    with pytest.raises(ValueError):
        transforms.check_schema(df, want, "fail")
    assert transforms.check_schema(df, want, "fail", cast=True).schema == want
