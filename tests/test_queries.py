"""Every registered query against DuckDB SQL on the smallest test tables."""

from __future__ import annotations

import pytest
from comparar import conectar, filas_duckdb, filas_spark

import __spark_entry__ as entrada
import oracle
from lonja.plans.queries import CONSULTAS


@pytest.fixture(scope="module")
def duck(sf_dir):
    return conectar(sf_dir)


def test_every_query_has_sql():
    assert set(CONSULTAS) == set(oracle.todas())
    assert set(CONSULTAS) <= set(entrada.queries())


def test_entry(spark):
    df = entrada.entry(spark)
    assert df.columns == ["canal", "fecha", "ventas_totales"] and df.count() > 0


@pytest.mark.parametrize("nombre", sorted(CONSULTAS))
def test_query_matches_sql(spark, duck, sf_dir, nombre):
    columnas, filas = filas_spark(entrada.queries()[nombre](spark, sf_dir))
    esperadas, datos = filas_duckdb(duck, entrada.oracle_sql()[nombre])
    assert columnas == esperadas
    assert filas == datos
    assert filas
