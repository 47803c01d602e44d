"""The reasons of a feed's rejects by run date: the feed is worked out once, no rule more than once a row."""

from __future__ import annotations

from collections import Counter
from datetime import timedelta

import pytest
from pyspark.sql import functions as F
from test_conform import tiendas

from lonja import feeds
from lonja.contracts import VENTAS_TIENDAS
from lonja.operators import bosquejos
from lonja.operators.conform import por_motivo
from lonja.plans import queries, silver
from lonja.sources import lake

FILAS = [
    {"id_transaccion": "3-1"},
    {"id_transaccion": "3-2", "qty": 0.0, "codigo_producto": None},
    {"id_transaccion": "3-2", "qty": 0.0, "codigo_producto": None},  # comes twice, counts twice
    {"id_transaccion": "6-1", "total": -1.0},  # a return
    {"id_transaccion": "4-1", "precio": None, "codigo_tienda": " "},
    {"id_transaccion": "7-1", "qty": float("nan"), "fecha_hora_venta": None},
    {"id_transaccion": "7-2", "total": 0.0},
    {"id_transaccion": None, "qty": -1.0},  # of no run date
]
VECES = {
    "cantidad_no_positiva": 2, "vacio:sku": 2, "nulo:precio_unitario": 1, "vacio:tienda_id": 1, "tipo:cantidad": 1,
    "nulo:vendido_en": 1, "monto_no_positivo": 1,
}


@pytest.fixture
def cuenta(spark, monkeypatch, tmp_path):
    """Runs the query over FILAS; how often a row of the feed was worked out is added up."""
    vistas = spark.sparkContext.accumulator(0)

    def ver(x):
        vistas.add(1)
        return x

    contada = F.udf(ver, "string").asNondeterministic()
    feed = tiendas(spark, *FILAS).withColumn("id_transaccion", contada("id_transaccion"))
    monkeypatch.setattr(feeds, "ventas_tiendas", lambda *a: feed)
    monkeypatch.setattr(queries, "espacio", lambda *a: str(tmp_path))
    return vistas


def test_all_run_dates_come_from_one_look_at_the_feed(spark, cuenta, tmp_path):
    antes = spark.sparkContext._jsc.getPersistentRDDs().size()
    hallados = queries.CONSULTAS["motivos_frecuentes"](spark, "").collect()
    assert {f["valor"]: f["veces"] for f in hallados} == VECES and len(hallados) == len(VECES)
    assert cuenta.value == len(FILAS)
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == antes
    guardados = lake.leer_silver(spark, "motivos", str(tmp_path), queries.RUN_DATE, queries.RUN_DATE + timedelta(days=2))
    # a run date without rejects has its sketches, too
    assert {f["day"]: f["filas"] for f in guardados.collect()} == {13: 4, 14: 5, 15: 0}


def test_no_run_date_has_rejects(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(feeds, "ventas_tiendas", lambda *a: tiendas(spark, {"id_transaccion": "3-1"}))
    assert queries.CONSULTAS["motivos_frecuentes"](spark, "").collect() == []


def test_the_rules_are_not_copied_into_joins(spark, sf_dir, monkeypatch):
    """Spark's own filter on the array's size would bring all rules there, once for each of them."""
    planes, bosquejar = [], bosquejos.bosquejar

    def mirar(df, *a, **k):
        planes.append(df._jdf.queryExecution().executedPlan().toString())
        return bosquejar(df, *a, **k)

    monkeypatch.setattr(bosquejos, "bosquejar", mirar)
    queries.CONSULTAS["motivos_frecuentes"](spark, sf_dir).collect()
    assert len(planes) == 3 and all("size(" not in p and "InMemoryTableScan" in p for p in planes)


def test_one_row_per_reason(spark, run_ts):
    malas = silver.rechazos(tiendas(spark, *FILAS), VENTAS_TIENDAS, run_ts)
    uno_a_uno = Counter(map(tuple, por_motivo(malas, "venta_id").collect()))
    assert uno_a_uno == Counter((f["venta_id"], m) for f in malas.collect() for m in f["_motivos"])
    vacias = malas.withColumn("_motivos", F.expr("IF(venta_id = '7-2', NULL, filter(_motivos, m -> false))"))
    assert por_motivo(vacias, "venta_id").collect() == []
