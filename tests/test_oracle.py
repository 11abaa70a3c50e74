"""Every registered query against its SQL oracle on the smallest driver tables."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E  # noqa: E402
from check_oracle import TABLES, frame_hash  # noqa: E402

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("key", sorted(E.queries()))
def test_query_matches_oracle(spark, con, key):
    got = E.queries()[key](spark, SF).toPandas()
    sql = E.oracle_sql().get(key)
    if sql is None:
        assert len(got) > 0
        return
    want = con.execute(sql).df()
    assert frame_hash(got)[:3] == frame_hash(want)[:3]


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "msg_number" in df.columns
