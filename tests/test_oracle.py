"""Every catalog query against its DuckDB oracle on sf0.001 (the driver's
correctness gate runs the same comparison at sf0.01), plus the entry smoke."""

import os

import duckdb
import pytest

import __spark_entry__ as E
from cohortwise.plans.catalog import CATALOG
from tools.check import TABLES, _hash, _rows

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute("SET enable_progress_bar = false")
    for t in TABLES:
        p = f"{SF}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "churn_risk_level" in df.columns


def test_every_query_has_oracle_or_is_listed():
    missing = set(CATALOG) - set(E.oracle_sql())
    assert missing == set(), missing


@pytest.mark.parametrize("name", sorted(CATALOG))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    srows = [tuple(r) for r in df.collect()]
    cur = con.execute(E.oracle_sql()[name])
    orows = cur.fetchall()
    ocols = [c[0] for c in cur.description]
    assert sorted(df.columns) == sorted(ocols)
    assert len(srows) == len(orows)
    assert _hash(_rows(df.columns, srows)) == _hash(_rows(ocols, orows))
