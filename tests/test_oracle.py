"""Every catalogue query against its DuckDB oracle SQL on the smallest tables."""

import os
import sys

import pytest

from conftest import SF_SMALL

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
import oracle_compare as OC  # noqa: E402

import __spark_entry__ as E
from fintide.plans import catalog

QUERIES = catalog.queries()
ORACLE = catalog.oracle_sql()

@pytest.fixture(scope="module")
def duck():
    return OC.duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    r = OC.compare(spark, duck, name, QUERIES[name], ORACLE.get(name), SF_SMALL)
    assert r["ok"] is not False, r


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "equity_pct" in df.columns
