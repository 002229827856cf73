"""Queries against their DuckDB SQL, and registration."""

import math

import duckdb
import pytest

from lendwise.llm import queries

SF = "/root/testdata/sf0.001"


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    same = lambda v: None if isinstance(v, float) and math.isnan(v) else v
    return sorted((tuple(same(r[i]) for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_equals_sql(spark, name):
    with duckdb.connect(config={"memory_limit": "2GB", "threads": 2}) as con:
        for table in ("documents", "pages", "benchmark", "labels", "conversations", "embeddings"):
            con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
        result = con.execute(queries.ORACLE[name])
        names, expected = [c[0] for c in result.description], result.fetchall()
    got = queries.QUERIES[name](spark, SF)
    assert sorted(names) == sorted(got.columns)
    assert _rows(got.columns, got.collect()) == _rows(names, expected)


def test_entry_registers_every_operator():
    import __spark_entry__ as entry
    numbers = {n.split("_")[0] for n in entry.queries() if n.startswith("op")}
    assert numbers == {f"op{i}" for i in range(1, 14)}
    assert "pipeline" in entry.queries()


@pytest.mark.parametrize("name", ["op3_quality_rules", "op9_secret_scans"])
def test_native_queries_run_no_python(spark, name):
    plan = queries.QUERIES[name](spark, SF)._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "MapInArrow"))
