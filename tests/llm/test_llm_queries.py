"""Queries with SQL against DuckDB on the smallest tables, and what is registered."""

from __future__ import annotations

import pytest
from comparar import conectar, filas_duckdb, filas_spark

import __spark_entry__ as entry
from lonja.llm import queries


def test_all_are_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))
    assert set(queries.QUERIES) | {"pipeline"} <= set(entry.queries())
    assert set(queries.SQL) <= set(entry.oracle_sql()) and set(queries.SQL) <= set(queries.QUERIES)


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_matches_sql(spark, sf_dir, name):
    columns, rows = filas_spark(queries.QUERIES[name](spark, sf_dir))
    expected, data = filas_duckdb(conectar(sf_dir), queries.SQL[name])
    assert columns == expected and rows == data and rows
