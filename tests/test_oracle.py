"""Differential test: every registered query against its DuckDB oracle.

Also checks each executed plan for the scale rules: no cartesian product or
nested-loop join, and no Python UDF in any query.
"""

import pytest

import __spark_entry__ as entry
from small_tables import SF_SMALL
from lendwise.plans import registry
from oracle_check import compare, duck

KEYS = sorted(registry.QUERIES)
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython")


@pytest.fixture
def con():
    """A database per query: a fatal error in one cannot fail the next."""
    with duck(SF_SMALL, memory="2GB", threads=2) as con:
        yield con


def test_registry_complete():
    assert set(registry.ORACLE) == set(registry.QUERIES)
    assert set(registry.QUERIES) <= set(entry.queries())
    assert len(KEYS) >= 100


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, con, key):
    fn, sql = entry.queries()[key], entry.oracle_sql()[key]
    r = compare(spark, con, key, fn, sql, SF_SMALL)
    assert r["cols_match"] and r["types_match"], r
    assert r["spark_rows"] == r["oracle_rows"], r
    assert r["hash_match"], r
    plan = fn(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert not [f for f in FORBIDDEN if f in plan]


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["member_id", "payment_history_pts", "defaulters_history_pts",
                          "financial_health_pts", "loan_score", "loan_final_grade", "n_rows"]
    assert df.count() > 0
