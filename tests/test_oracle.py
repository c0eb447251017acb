"""Every registered query equals its DuckDB twin (rows, columns, values)."""

import pytest

import __spark_entry__ as entry_module
from conftest import SF
from oracle_compare import compare, duck

QUERIES = {k: q for k, q in entry_module.queries().items() if k not in entry_module.LLM_QUERIES}
ORACLE = {k: sql for k, sql in entry_module.oracle_sql().items() if k in QUERIES}


@pytest.fixture(scope="module")
def con():
    return duck(SF["0.01"])


def test_every_exact_query_has_an_oracle():
    assert set(QUERIES) - entry_module.APPROXIMATE == set(ORACLE)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - entry_module.APPROXIMATE))
def test_query_matches_oracle(spark, con, name):
    result = compare(spark, SF["0.01"], name, QUERIES[name], ORACLE[name], con)
    assert result["ok"], result


def test_entry_smoke(spark):
    df = entry_module.entry(spark)
    rows = df.collect()
    assert len(rows) == 90 and df.columns[-1] == "reconciliation_ts"
