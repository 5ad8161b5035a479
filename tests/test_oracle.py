"""Every registered query with SQL equals its DuckDB statement (sf0.001)."""

import pytest

import __spark_entry__ as E
from check_oracle import compare, duck

from conftest import SF_SMALL

SLOW = {"als_sweep", "experiment_results_csv"}
KEYS = [k for k in E.queries() if k in E.oracle_sql() and k not in SLOW]


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("key", KEYS)
def test_matches_sql(spark, con, key):
    status, ns, nd, _ = compare(spark, con, SF_SMALL, key, E.oracle_sql()[key])
    assert status == "OK", (key, status, ns, nd)


def test_every_key_has_callable():
    q = E.queries()
    assert set(E.oracle_sql()) <= set(q)
    assert len(q) >= 50


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["recording_mbid", "score", "rank"]
    assert 0 < len(rows) <= 100
