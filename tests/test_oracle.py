"""Every registered query against its DuckDB oracle on the smallest tables."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as E  # noqa: E402
from encore.plans import catalog  # noqa: E402
from tools.oracle_check import TABLES, _rows  # noqa: E402

SF = "/root/testdata/sf0.001"
NAMES = sorted(catalog.queries())


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def test_every_query_has_oracle_or_is_listed():
    missing = set(catalog.queries()) - set(E.oracle_sql())
    assert missing <= {"als_recommend", "als_recommend_catalogue"}


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    got = E.queries()[name](spark, SF).toPandas()
    sql = E.oracle_sql().get(name)
    if sql is None:
        assert len(got) > 0
        return
    exp = con.execute(sql).df()
    assert sorted(got.columns) == sorted(exp.columns)
    assert len(got) == len(exp)
    assert _rows(got) == _rows(exp)


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() == 5
