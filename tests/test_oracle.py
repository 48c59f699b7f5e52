"""Every registered query equals its DuckDB oracle on the sf0.001 fixture."""

import pytest

from conftest import SF_SMALL
from procura.checks.compare import compare
from procura.checks.registry import QUERIES


@pytest.mark.parametrize("name", list(QUERIES))
def test_matches_oracle(spark, name):
    r = compare(spark, name, SF_SMALL)
    assert r["columns_match"], r
    assert r["match"], r


def test_entry_contract(spark):
    import __spark_entry__ as e

    assert set(QUERIES) <= set(e.queries())
    assert set(QUERIES) <= set(e.oracle_sql()) <= set(e.queries())
    df = e.entry(spark)
    assert df.count() > 0
    assert df.columns[0] == "order_number"
