from __future__ import annotations

import random
from datetime import datetime

import pytest

from lonja.operators.dedup import deduplicar
from lonja.operators.quality import duplicados


def plan(df) -> str:
    return df._jdf.queryExecution().toString()


def test_latest_wins_and_null_order_is_last(spark):
    t = datetime(2024, 1, 1)
    filas = [("a", None, 1), ("a", t, 2), ("a", t.replace(day=2), 3), ("b", None, 4)]
    df = spark.createDataFrame(filas, "k string, t timestamp, x int")
    assert {(f["k"], f["x"]) for f in deduplicar(df, "k", "t").collect()} == {("a", 3), ("b", 4)}


def test_ties_do_not_depend_on_partitioning(spark):
    filas = [(f"k{i % 5}", 1, i, f"s{i % 7}") for i in range(200)]
    esperado = None
    for semilla in range(3):
        random.Random(semilla).shuffle(filas)
        df = spark.createDataFrame(filas, "k string, t int, x int, s string").repartition(semilla + 2)
        visto = sorted(tuple(f) for f in deduplicar(df, "k", "t").collect())
        esperado = esperado or visto
        assert visto == esperado


def test_rows_with_null_keys_count_as_one_key(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), ("a", 1)], "k string, t int")
    assert deduplicar(df, "k", "t").count() == 2


def test_missing_order_column(spark):
    df = spark.createDataFrame([("a", 1)], "k string, t int")
    with pytest.raises(ValueError, match="order column"):
        deduplicar(df, "k", "otra")
    assert deduplicar(df, "k", ("t", "otra")).count() == 1


def test_hot_key_is_cut_before_the_exchange(spark):
    """A third of the rows share one key; one row per key and task is what gets shuffled."""
    df = spark.range(30_000, numPartitions=8).selectExpr("IF(id % 3 = 0, 'hot', concat('k', id)) AS k", "id AS t")
    unico = deduplicar(df, "k", "t")
    assert "WindowGroupLimit" in plan(unico).split("Exchange")[-1]
    assert unico.count() == 20_001
    assert unico.where("k = 'hot'").first()["t"] == 29_997


def test_duplicate_histogram(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,), (None,), (None,)], "k string")
    assert {tuple(f) for f in duplicados(df, ["k"]).collect()} == {(1, 1, 1), (2, 1, 2), (3, 1, 3)}
