"""Every catalog query against its DuckDB oracle SQL on sf0.01 (the driver's check)."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as entry  # noqa: E402
from check_oracle import duck, rows_of, type_problems  # noqa: E402
from conftest import SF_SMALL, SF_TINY  # noqa: E402

SQLS = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_sql_has_a_query():
    assert set(SQLS) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(SQLS))
def test_query_matches_oracle(spark, con, name):
    sdf = entry.queries()[name](spark, SF_SMALL)
    srows = [tuple(r) for r in sdf.collect()]
    res = con.execute(SQLS[name])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(sdf.columns) == sorted(dcols)
    assert type_problems(sdf, res) == []
    assert len(srows) == len(drows)
    assert rows_of(sdf.columns, srows) == rows_of(dcols, drows)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns == ["year", "flights", "avg_delay", "pct_delayed", "p95_delay"]
    assert SF_TINY in entry.SF_SMOKE
