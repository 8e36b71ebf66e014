"""Every registered query against its DuckDB oracle (sf0.001), and the
rows-only ones for a stable, non-empty result."""

import pytest

import __spark_entry__ as E
from helpers import canon, duck

from conftest import SF001

QUERIES = E.queries()
ORACLES = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF001)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF001)
    rows = df.collect()
    cur = con.execute(ORACLES[name])
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    assert canon(df.columns, rows) == canon(dcols, drows)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_rows_only(spark, name):
    df = QUERIES[name](spark, SF001)
    assert df.count() > 0


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["day", "doc", "count"]


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
