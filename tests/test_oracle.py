"""Every catalogue query against its DuckDB oracle on the smallest test data (the driver runs the
same comparison at sf0.01; ``python -m shopflow.plans.verify`` does it by hand)."""

import pytest

import __spark_entry__ as entry
from shopflow.plans.catalog import QUERIES
from shopflow.plans.verify import compare_one, duck

from conftest import SF_SMALL

NAMES = sorted(QUERIES)
SQL = {k: v for k, v in entry.oracle_sql().items() if k in QUERIES}


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_oracle_or_is_rows_only():
    assert set(NAMES) == set(SQL) and set(NAMES) <= set(entry.queries())


@pytest.mark.parametrize("name", [n for n in NAMES if n in SQL])
def test_matches_oracle(spark, con, name):
    ok, detail, _, ns, nd = compare_one(spark, con, name, entry.queries()[name], SQL[name], SF_SMALL)
    assert ok, detail
    assert ns == nd


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["area", "product_name", "clickcount", "rk", "city_remark"]
    assert df.count() > 0
