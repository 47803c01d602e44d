"""Deliveries that repeat, mix layouts, lack dates or come in parts, on small hand-made orders."""

from __future__ import annotations

import json
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F
from test_streaming import aterrizar, pedido

from lonja.contracts import INVENTARIO_ERP, VENTAS_ECOMMERCE, VENTAS_TIENDAS
from lonja.plans import gold, silver
from lonja.sources import bronze, incremental, lake
from lonja.streaming import microbatch

DIA = date(2025, 4, 13)
SOLO = (VENTAS_ECOMMERCE,)


def tipados(spark, pedidos):
    df = spark.read.json(spark.sparkContext.parallelize([json.dumps(p) for p in pedidos]))
    return df.withColumn("created_at", F.col("created_at").cast("timestamp_ntz")).select(VENTAS_ECOMMERCE.bronze.names)


def llegan(spark, raiz, pedidos, dia=DIA, **partes):
    tipados(spark, pedidos).write.parquet(bronze.ruta_bronze(raiz, "ventas_ecommerce", dia, **partes))


def total(spark, oro):
    return float(gold.leer_consolidadas(spark, oro).agg(F.sum("ventas_totales")).first()[0])


def correr(spark, b, s, g, dia=DIA, **opciones):
    silver.procesar_silver(spark, b, s, dia, fuentes=SOLO, **opciones)
    return gold.procesar_gold(spark, s, g, dia)


@pytest.fixture
def rutas(tmp_path):
    return [str(tmp_path / n) for n in ("bronze", "silver", "gold")]


def test_hours_of_a_day_are_not_counted_twice(spark, rutas):
    b, s, g = rutas
    llegan(spark, b, [pedido(1, 9), pedido(2, 9)], hora=10)
    llegan(spark, b, [pedido(2, 9), pedido(3, 10)], hora=11)
    for hora in (10, 11, 10):
        correr(spark, b, s, g, hora=hora)
    assert total(spark, g) == 30
    assert lake.leer_silver(spark, "ventas", s, DIA).groupBy("hour").count().count() == 2
    with pytest.raises(ValueError, match="by hour"):
        silver.procesar_silver(spark, b, s, DIA, fuentes=SOLO)
    assert bronze.leer_bronze(spark, VENTAS_ECOMMERCE, b, DIA).count() == 4
    otra = s + "_dia"
    silver.procesar_silver(spark, b, otra, DIA, fuentes=SOLO)
    with pytest.raises(ValueError, match="by day"):
        silver.procesar_silver(spark, b, otra, DIA, fuentes=SOLO, hora=10)


def test_a_sale_redelivered_after_midnight_counts_once(spark, rutas):
    b, s, g = rutas
    otro = DIA + timedelta(days=1)
    llegan(spark, b, [pedido(1, 10), pedido(2, 10)])
    llegan(spark, b, [pedido(1, 10), pedido(2, 11, 3000, dia=2)], otro)  # sale 2 moves to another date
    correr(spark, b, s, g)
    assert total(spark, g) == 20
    correr(spark, b, s, g, otro)
    por_fecha = {f["fecha"].day: float(f["ventas_totales"]) for f in gold.leer_consolidadas(spark, g).collect()}
    assert por_fecha == {1: 10.0, 2: 30.0}
    correr(spark, b, s, g)  # the first run again changes nothing
    assert total(spark, g) == 40


def test_a_rerun_without_a_sale_takes_it_back(spark, rutas, tmp_path):
    b, s, g = rutas
    otro = DIA + timedelta(days=1)
    llegan(spark, b, [pedido(1, 10)])
    llegan(spark, b, [pedido(1, 12, 5000), pedido(2, 10)], otro)
    correr(spark, b, s, g)
    correr(spark, b, s, g, otro)
    assert total(spark, g) == 60
    b2 = str(tmp_path / "corregido")
    llegan(spark, b2, [pedido(3, 10)], otro)
    correr(spark, b2, s, g, otro)
    assert total(spark, g) == 20  # sale 1 as first delivered, and sale 3


def test_gold_of_one_date_reads_one_folder(spark, rutas):
    b, s, g = rutas
    llegan(spark, b, [pedido(i, 10, dia=i) for i in range(1, 10)])
    correr(spark, b, s, g)
    uno = gold.leer_consolidadas(spark, g, "2025-04-03")
    assert uno.count() == 1 and len(uno.inputFiles()) == 1
    assert gold.leer_consolidadas(spark, g, "2025-05-03").count() == 0
    assert gold.procesar_gold(spark, s, g, DIA, detalle=True) == 9
    assert gold.leer_gold(spark, "ventas_por_tienda_sku_dia", g, ["2025-04-03"]).count() == 1
    mensual = g + "_mes"
    assert gold.procesar_gold(spark, s, mensual, DIA, grano="mes") == 9
    llegan(spark, b, [pedido(1, 11, 2000, dia=4)], DIA + timedelta(days=1))
    silver.procesar_silver(spark, b, s, DIA + timedelta(days=1), fuentes=SOLO)
    gold.procesar_gold(spark, s, mensual, DIA + timedelta(days=1), grano="mes")
    assert gold.leer_consolidadas(spark, mensual, "2025-04-01").count() == 0
    assert float(gold.leer_consolidadas(spark, mensual, "2025-04-04").first()["ventas_totales"]) == 30


def test_a_pruned_read_lists_one_folder(spark, rutas):
    b, s, _ = rutas
    dias = [DIA + timedelta(days=i) for i in range(5)]
    for d in dias:
        llegan(spark, b, [pedido(1, 10)], d)
    filas = silver.reprocesar(spark, b, s, dias, fuentes=SOLO)
    assert all(f == {"ventas": 1, "ventas_apartadas": 0, "calidad": 2} for f in filas.values())
    uno = lake.leer_silver(spark, "ventas", s, DIA)
    assert len(uno.inputFiles()) == 1 and uno.count() == 1
    assert lake.leer_silver(spark, "ventas", s, DIA - timedelta(days=9)).count() == 0


def test_two_receivers_and_a_plain_drop_share_a_date(spark, rutas, tmp_path):
    b, s, _ = rutas
    llegan(spark, b, [pedido(1, 10)])
    llegan(spark, b, [pedido(2, 10)], lote=7)  # typed files under a batch of an older layout
    for n in (3, 4):
        carpeta = tmp_path / f"eventos{n}"
        aterrizar(carpeta, "1.json", [pedido(n, 10)], "2025-04-13 10:15:00")
        flujo = microbatch.leer_eventos(spark, VENTAS_ECOMMERCE, str(carpeta))
        microbatch.ejecutar_microlotes(
            flujo, VENTAS_ECOMMERCE, bronze=b, silver=s, checkpoint=str(tmp_path / f"marcas{n}")
        )
    # a lost checkpoint: the events come again, nothing of what lies there is replaced
    flujo = microbatch.leer_eventos(spark, VENTAS_ECOMMERCE, str(tmp_path / "eventos3"))
    microbatch.ejecutar_microlotes(flujo, VENTAS_ECOMMERCE, bronze=b, silver=s, checkpoint=str(tmp_path / "otras"))
    assert bronze.leer_bronze(spark, VENTAS_ECOMMERCE, b, DIA).count() == 5
    ventas = lake.leer_silver(spark, "ventas", s, DIA).select("venta_id", "monto_total").collect()
    assert sorted((v, float(m)) for v, m in ventas) == [(f"o{i}", 10.0) for i in (1, 2, 3, 4)]


def test_an_event_without_a_run_date_takes_its_arrival(spark, rutas, tmp_path):
    b, s, _ = rutas
    sin = {**pedido(2, 10), "created_at": None}
    aterrizar(tmp_path / "eventos", "1.json", [pedido(1, 10), sin], "2025-04-13 10:15:00")
    flujo = microbatch.leer_eventos(spark, VENTAS_ECOMMERCE, str(tmp_path / "eventos"))
    microbatch.ejecutar_microlotes(
        flujo, VENTAS_ECOMMERCE, bronze=b, silver=s, checkpoint=str(tmp_path / "c"), fecha=F.to_date("created_at")
    )
    assert bronze.leer_bronze(spark, VENTAS_ECOMMERCE, b, "2025-04-01").count() == 1
    assert lake.leer_silver(spark, "ventas_apartadas", s, DIA).select("clase").first()["clase"] == "rechazo"


def test_rebuilding_is_retried_after_a_failure(spark, rutas, tmp_path, monkeypatch):
    b, s, g = rutas
    aterrizar(tmp_path / "eventos", "1.json", [pedido(1, 10)], "2025-04-13 10:15:00")

    def una_vez():
        flujo = microbatch.leer_eventos(spark, VENTAS_ECOMMERCE, str(tmp_path / "eventos"))
        microbatch.ejecutar_microlotes(
            flujo, VENTAS_ECOMMERCE, bronze=b, silver=s, gold=g, checkpoint=str(tmp_path / "c")
        )

    with monkeypatch.context() as m:
        m.setattr(microbatch, "reprocesar", lambda *a, **k: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            una_vez()
    una_vez()  # no new events, the noted date is worked on
    assert total(spark, g) == 10


def test_one_feed_alone_leaves_the_others(spark, sf_dir, rutas):
    from lonja import feeds

    b, s, _ = rutas
    for feed, fuente in (
        (feeds.ventas_tiendas, VENTAS_TIENDAS),
        (feeds.ventas_ecommerce, VENTAS_ECOMMERCE),
        (feeds.inventario, INVENTARIO_ERP),
    ):
        feed(spark, sf_dir).write.parquet(bronze.ruta_bronze(b, fuente.tabla, DIA))
    silver.procesar_silver(spark, b, s, DIA)
    antes = lake.leer_silver(spark, "ventas", s, DIA).count()
    silver.procesar_silver(spark, b, s, DIA, fuentes=SOLO)
    silver.procesar_silver(spark, b, s, DIA, fuentes=(INVENTARIO_ERP,))
    assert lake.leer_silver(spark, "ventas", s, DIA).count() == antes
    assert lake.leer_silver(spark, "calidad", s, DIA).count() == 6


def test_returns_are_unique_and_the_accounts_close(spark, rutas):
    b, s, _ = rutas
    vuelta = pedido(1, 10, -1000)
    llegan(spark, b, [vuelta, vuelta, pedido(2, 10), pedido(2, 10), pedido(3, 10, 0)])
    silver.procesar_silver(spark, b, s, DIA, fuentes=SOLO)
    m = lake.leer_silver(spark, "calidad", s, DIA).where("etapa = 'bronze_raw'").first()
    assert (m["total"], m["devoluciones"], m["rechazadas"], m["duplicadas"]) == (5, 1, 1, 2)
    assert lake.leer_silver(spark, "ventas_apartadas", s, DIA).where("clase = 'devolucion'").count() == 1


def test_first_load_and_overlap(spark, tmp_path):
    raiz, t0 = str(tmp_path), datetime(2025, 4, 1)
    tabla = tipados(spark, [pedido(i, i) for i in range(1, 10)])
    visibles = tabla.where("order_id <> 'o3'")  # committed late
    marca = incremental.ingerir(
        visibles, VENTAS_ECOMMERCE, raiz, DIA, "created_at", None, t0 + timedelta(hours=5)
    )
    assert marca == t0 + timedelta(hours=5)
    siguiente = incremental.ingerir(
        tabla, VENTAS_ECOMMERCE, raiz, DIA, "created_at", marca, datetime(2025, 4, 2), solape=timedelta(hours=3)
    )
    assert siguiente == t0 + timedelta(hours=9)
    crudas = bronze.leer_bronze(spark, VENTAS_ECOMMERCE, raiz, DIA)
    assert crudas.select("order_id").distinct().count() == 9
    assert silver.transformar_ventas_ecommerce(crudas, t0).count() == 9
    vacia = tabla.where("false")
    assert incremental.ingerir(vacia, VENTAS_ECOMMERCE, raiz, DIA, "created_at", None, t0, origen="x") is None
    opciones = incremental.opciones_jdbc("jdbc:x", "t", "c", None, t0)
    assert opciones["lowerBound"] == "2000-01-01 00:00:00"


def test_dimensions_are_written(spark, rutas):
    b, s, g = rutas
    llegan(spark, b, [pedido(1, 10)])
    silver.procesar_silver(spark, b, s, DIA, permitir_vacio=True)
    gold.procesar_gold(spark, s, g, DIA)
    gold.procesar_dimensiones(spark, s, g, DIA)
    assert lake.leer_silver(spark, "dim_producto", g, DIA).select("sku", "tiendas_con_stock").collect() == [("A", 0)]
    assert lake.leer_silver(spark, "dim_fecha", g).count() == 1
