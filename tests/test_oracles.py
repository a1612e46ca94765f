"""Every registered query against its DuckDB oracle on the smallest scale factor."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))
import __spark_entry__ as entry  # noqa: E402
from check_oracles import TABLES, digest  # noqa: E402

SF = "/root/testdata/sf0.001"
ORACLES = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")
@pytest.mark.parametrize("key", sorted(entry.queries()))
def test_query_matches_oracle(spark, con, key):
    got = entry.queries()[key](spark, SF).toPandas()
    if key not in ORACLES:
        assert len(got.columns) > 0
        return
    want = con.execute(ORACLES[key]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(got) == len(want)
    assert digest(got) == digest(want)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() >= 0 and len(df.columns) == 7
