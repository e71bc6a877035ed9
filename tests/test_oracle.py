"""Every registered payment query against its DuckDB oracle (sf0.001, the driver's check in small)."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from tests.oracle_check import compare, duck

SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_small):
    return duck(sf_small)


# the optional training-data queries have tests of their own
REFERENCE = sorted(n for n in entry.queries() if n != "pipeline" and not n.startswith("op"))


@pytest.mark.parametrize("name", REFERENCE)
def test_query_matches_oracle(spark, sf_small, con, name):
    r = compare(spark, name, entry.queries()[name], SQL.get(name), sf_small, con)
    if r["ok"] is None:
        assert r["rows"] >= 0
    else:
        assert r["ok"], r
