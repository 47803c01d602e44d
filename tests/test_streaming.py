from __future__ import annotations

import json
import os
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from lonja.contracts import VENTAS_ECOMMERCE, VENTAS_TIENDAS
from lonja.plans import gold, silver
from lonja.sources import bronze, lake
from lonja.streaming import microbatch, stateful

FUENTES = (VENTAS_TIENDAS, VENTAS_ECOMMERCE)
DIA_1, DIA_2 = date(2025, 4, 13), date(2025, 4, 14)


def pedido(numero, hora, monto=1000, dia=1):
    return {
        "order_id": f"o{numero}",
        "product_sku": "a",
        "quantity": 1,
        "unit_price": monto,
        "total_amount": monto,
        "created_at": f"2025-04-{dia:02d} {hora:02d}:00:00",
        "customer_email": f"c{numero}@x.com",
    }


def aterrizar(carpeta, nombre, pedidos, llegada):
    carpeta.mkdir(exist_ok=True)
    archivo = carpeta / nombre
    archivo.write_text("\n".join(json.dumps(p) for p in pedidos))
    instante = datetime.fromisoformat(f"{llegada}+00:00").timestamp()
    os.utime(archivo, (instante, instante))


class Lago:
    def __init__(self, spark, tmp_path):
        self.spark, self.eventos = spark, tmp_path / "eventos"
        self.b, self.s, self.g, self.c = (str(tmp_path / n) for n in ("bronze", "silver", "gold", "chk"))

    def correr(self):
        flujo = microbatch.leer_eventos(self.spark, VENTAS_ECOMMERCE, str(self.eventos), archivos_por_lote=1)
        return microbatch.ejecutar_microlotes(
            flujo, VENTAS_ECOMMERCE, bronze=self.b, silver=self.s, gold=self.g, checkpoint=self.c
        )

    def ventas(self, dia=None):
        df = lake.leer_silver(self.spark, "ventas", self.s, dia)
        return {f["venta_id"]: float(f["monto_total"]) for f in df.collect()}


@pytest.fixture
def lago(spark, tmp_path):
    return Lago(spark, tmp_path)


def test_microbatches_latest_wins_late_rows_and_restart(spark, lago):
    aterrizar(lago.eventos, "1.json", [pedido(1, 10), pedido(2, 10)], "2025-04-13 10:15:00")
    # A newer version of 1, a stale redelivery of 2, and a sale of the week before.
    aterrizar(
        lago.eventos, "2.json", [pedido(1, 11, 2000), pedido(2, 9, 500), pedido(3, 1)], "2025-04-13 10:30:00"
    )
    lago.correr()
    assert lago.ventas(DIA_1) == {"o1": 20.0, "o2": 10.0, "o3": 10.0}
    assert gold.leer_consolidadas(spark, lago.g).agg(F.sum("ventas_totales")).first()[0] == 40

    lago.correr()  # nothing new
    assert lago.ventas() == {"o1": 20.0, "o2": 10.0, "o3": 10.0}

    aterrizar(lago.eventos, "3.json", [pedido(4, 1, dia=13)], "2025-04-14 00:05:00")
    lago.correr()
    assert lago.ventas(DIA_2) == {"o4": 10.0}
    assert lago.ventas(DIA_1) == {"o1": 20.0, "o2": 10.0, "o3": 10.0}

    # The stream equals the batch job over the Bronze it landed.
    otra = lago.s + "_lote"
    for dia in (DIA_1, DIA_2):
        silver.procesar_silver(spark, lago.b, otra, dia, fuentes=FUENTES, permitir_vacio=True)
    lote = {f["venta_id"]: float(f["monto_total"]) for f in lake.leer_silver(spark, "ventas", otra).collect()}
    assert lote == lago.ventas()


def test_broken_events_end_up_in_the_rejects(spark, lago):
    aterrizar(lago.eventos, "1.json", [pedido(1, 10)], "2025-04-13 10:15:00")
    (lago.eventos / "2.json").write_text('{"order_id": "o2", "prod')
    os.utime(lago.eventos / "2.json", (datetime(2025, 4, 13, 18).timestamp(),) * 2)
    lago.correr()
    fuera = lake.leer_silver(spark, "ventas_apartadas", lago.s)
    assert fuera.where(F.array_contains("motivos", "registro_corrupto")).count() == 1
    assert lago.ventas() == {"o1": 10.0}
    assert bronze.leer_bronze(spark, VENTAS_ECOMMERCE, lago.b, DIA_1).count() == 2


def flujo(spark, lago, run_ts):
    eventos = microbatch.leer_eventos(spark, VENTAS_ECOMMERCE, str(lago.eventos), archivos_por_lote=1)
    return stateful.conformar_flujo(eventos, VENTAS_ECOMMERCE, run_ts)


def test_first_delivery_within_the_horizon(spark, lago, run_ts, tmp_path):
    aterrizar(lago.eventos, "1.json", [pedido(1, 10), pedido(1, 10)], "2025-04-13 10:15:00")
    aterrizar(lago.eventos, "2.json", [pedido(1, 12, 2000), pedido(2, 12)], "2025-04-13 10:30:00")
    salida, marcas = str(tmp_path / "out"), str(tmp_path / "c2")
    for _ in range(2):
        unicas = stateful.primera_entrega(flujo(spark, lago, run_ts), "5 days")
        stateful.escribir_anexo(unicas, salida, marcas).awaitTermination()
    filas = {f["venta_id"]: float(f["monto_total"]) for f in spark.read.parquet(salida).collect()}
    assert filas == {"o1": 10.0, "o2": 10.0}


def test_first_delivery_spread_over_arrivals(spark, lago, run_ts, tmp_path):
    """The two-step form gives the same sales."""
    for i in range(3):
        aterrizar(lago.eventos, f"{i}.json", [pedido(1, 10)] * 3 + [pedido(i + 2, 10)], f"2025-04-13 10:1{i}:00")
    eventos = microbatch.leer_eventos(spark, VENTAS_ECOMMERCE, str(lago.eventos))
    con_llegada = eventos.selectExpr("*", "CAST(created_at AS timestamp) AS vendido_en")
    unicas = stateful.primera_entrega(con_llegada, "5 days", llave="order_id", reparto=("_llegada",))
    salida = str(tmp_path / "out")
    stateful.escribir_anexo(unicas.select("order_id"), salida, str(tmp_path / "c2")).awaitTermination()
    assert sorted(f["order_id"] for f in spark.read.parquet(salida).collect()) == ["o1", "o2", "o3", "o4"]


def test_totals_over_batches_equal_the_batch_total(spark, lago, run_ts, tmp_path):
    aterrizar(lago.eventos, "1.json", [pedido(1, 10), pedido(2, 10, dia=2)], "2025-04-13 10:15:00")
    aterrizar(lago.eventos, "2.json", [pedido(1, 10), pedido(3, 10, 500)], "2025-04-13 10:30:00")
    totales = stateful.totales_en_flujo(stateful.primera_entrega(flujo(spark, lago, run_ts), "30 days"))
    salida = str(tmp_path / "tot")
    stateful.escribir_totales(totales, salida, str(tmp_path / "c2")).awaitTermination()
    vistos = {f["fecha"].day: float(f["ventas_totales"]) for f in stateful.leer_totales(spark, salida).collect()}
    assert vistos == {1: 15.0, 2: 10.0}


def test_late_sales_of_a_stream(spark, lago, run_ts, tmp_path):
    aterrizar(lago.eventos, "1.json", [pedido(1, 10, dia=13), pedido(2, 10, dia=1)], "2025-04-13 10:15:00")
    eventos = microbatch.leer_eventos(spark, VENTAS_ECOMMERCE, str(lago.eventos))
    ventas = stateful.conformar_flujo(eventos, VENTAS_ECOMMERCE, run_ts, conservar=("_llegada",))
    partes = {}
    for nombre, parte in zip(("a_tiempo", "tarde"), stateful.separar_tardias(ventas, "2 days"), strict=True):
        stateful.escribir_anexo(parte, str(tmp_path / nombre), str(tmp_path / f"c_{nombre}")).awaitTermination()
        partes[nombre] = [f["venta_id"] for f in spark.read.parquet(str(tmp_path / nombre)).collect()]
    assert partes == {"a_tiempo": ["o1"], "tarde": ["o2"]}


def test_late_split_keeps_every_row(spark):
    t = datetime(2025, 4, 13, 12)
    filas = [(1, t, t), (2, t.replace(day=1), t), (3, None, t)]
    df = spark.createDataFrame(filas, "id int, vendido_en timestamp, _llegada timestamp")
    a_tiempo, tarde = stateful.separar_tardias(df, "3 days")
    assert [f["id"] for f in tarde.collect()] == [2]
    assert sorted(f["id"] for f in a_tiempo.collect()) == [1, 3]
