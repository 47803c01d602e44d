"""Keyed state with a horizon and incremental totals: new checkpoints, restarts, state size, exact rows."""

from __future__ import annotations

from collections import Counter
from datetime import datetime, timedelta
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from test_streaming import aterrizar, pedido

from lonja.contracts import VENTAS_ECOMMERCE
from lonja.streaming import microbatch, stateful


def llegar(carpeta, n, pedidos):
    aterrizar(carpeta, f"{n}.json", pedidos, str(datetime(2025, 4, 13, 10) + timedelta(minutes=n)))


def limpias(spark, carpeta, run_ts):
    eventos = microbatch.leer_eventos(spark, VENTAS_ECOMMERCE, str(carpeta), archivos_por_lote=1)
    return stateful.conformar_flujo(eventos, VENTAS_ECOMMERCE, run_ts)


def primeras(spark, carpeta, run_ts, salida, marcas, horizonte="5 days", **opciones):
    consulta = stateful.escribir_primeras(
        limpias(spark, carpeta, run_ts), str(salida), str(marcas), horizonte, **opciones
    )
    consulta.awaitTermination()
    return consulta


def totales(spark, carpeta, run_ts, salida, marcas, **opciones):
    flujo = stateful.totales_en_flujo(limpias(spark, carpeta, run_ts))
    stateful.escribir_totales(flujo, str(salida), str(marcas), **opciones).awaitTermination()


def suma(spark, salida):
    return float(stateful.leer_totales(spark, str(salida)).agg(F.sum("ventas_totales")).first()[0] or 0)


def partes(spark, salida):
    return Counter((f["venta_id"], f["parte"]) for f in stateful.leer_primeras(spark, str(salida)).collect())


def test_a_new_checkpoint_neither_adds_nor_hides(spark, run_ts, tmp_path):
    carpeta, salida = tmp_path / "eventos", tmp_path / "primeras"
    for n in range(4):
        llegar(carpeta, n, [pedido(n, 10, dia=1 + n), pedido(0, 10)])
    primeras(spark, carpeta, run_ts, salida, tmp_path / "c1")
    esperadas = Counter({(f"o{n}", "a_tiempo"): 1 for n in range(4)}) + Counter({("o0", "repetidas"): 4})
    assert partes(spark, salida) == esperadas
    with pytest.raises(ValueError, match="another checkpoint"):
        primeras(spark, carpeta, run_ts, salida, tmp_path / "c2")
    assert partes(spark, salida) == esperadas
    primeras(spark, carpeta, run_ts, salida, tmp_path / "c2", reemplazar=True)
    assert partes(spark, salida) == esperadas
    # the first checkpoint goes on where it was, and is refused now as well
    with pytest.raises(ValueError, match="another checkpoint"):
        primeras(spark, carpeta, run_ts, salida, tmp_path / "c1")


def test_restarts_keep_the_state_and_late_rows_are_kept(spark, run_ts, tmp_path):
    carpeta, salida, marcas = tmp_path / "eventos", tmp_path / "primeras", tmp_path / "c"
    llegar(carpeta, 0, [pedido(1, 10, dia=10), pedido(2, 10, dia=2)])
    primeras(spark, carpeta, run_ts, salida, marcas)
    llegar(carpeta, 1, [pedido(1, 11, 2000, dia=10), pedido(3, 10, dia=3), pedido(4, 10, dia=6)])
    primeras(spark, carpeta, run_ts, salida, marcas)
    llegar(carpeta, 2, [pedido(4, 10, dia=6), pedido(2, 10, dia=2)])
    primeras(spark, carpeta, run_ts, salida, marcas)
    primeras(spark, carpeta, run_ts, salida, marcas)  # nothing new
    assert partes(spark, salida) == {
        ("o1", "a_tiempo"): 1, ("o1", "repetidas"): 1, ("o2", "a_tiempo"): 1, ("o2", "tardias"): 1,
        ("o3", "tardias"): 1, ("o4", "a_tiempo"): 1, ("o4", "repetidas"): 1,
    }
    primera = stateful.leer_primeras(spark, str(salida), "a_tiempo").where("venta_id = 'o1'").first()
    assert primera["monto_total"] == Decimal("10.00") and "parte" not in primera.asDict()


def test_rows_come_through_the_state_unchanged(spark, tmp_path):
    filas = [
        (1, "a", datetime(2025, 4, 1, 10, 0, 0, 123456), Decimal("99999999.99"), None, None, (1 << 62) + 1),
        (2, "b", datetime(2025, 4, 1, 10, 0, 0, 999999), Decimal("-0.01"), "", "é\"\n", -1),
        (3, "c", None, None, " x ", None, None),
    ]
    esquema = "id int, k string, t timestamp, d decimal(12,2), s string, u string, n long"
    spark.createDataFrame(filas, esquema).coalesce(1).write.parquet(str(tmp_path / "filas"))
    flujo = spark.readStream.schema(esquema).parquet(str(tmp_path / "filas"))
    stateful.escribir_primeras(
        flujo, str(tmp_path / "s"), str(tmp_path / "c"), "5 days", llave="k", tiempo="t"
    ).awaitTermination()
    leidas = stateful.leer_primeras(spark, str(tmp_path / "s"), "a_tiempo").orderBy("id").collect()
    assert [tuple(f) for f in leidas] == filas


def test_the_state_does_not_grow_with_the_batches(spark, run_ts, tmp_path):
    carpeta = tmp_path / "eventos"
    for n in range(14):
        llegar(carpeta, n, [pedido(10 * n + i, 10, dia=1 + 2 * n) for i in range(3)])
    consulta = primeras(spark, carpeta, run_ts, tmp_path / "s", tmp_path / "c")
    estado = [p["stateOperators"][0] for p in consulta.recentProgress if p["numInputRows"]]
    vivas = [e["numRowsTotal"] for e in estado]
    assert max(vivas[6:]) == max(vivas) <= 15 and vivas[-1] <= 12
    assert all(e["customMetrics"].get("rocksdbCommitCompactLatency", 0) >= 0 for e in estado)
    assert any(k.startswith("rocksdb") for k in estado[0]["customMetrics"])
    assert stateful.leer_primeras(spark, str(tmp_path / "s"), "a_tiempo").count() == 42


def test_totals_survive_a_new_checkpoint(spark, run_ts, tmp_path):
    carpeta, salida = tmp_path / "eventos", tmp_path / "totales"
    assert stateful.leer_totales(spark, str(salida)).collect() == []
    for n in range(4):
        llegar(carpeta, n, [pedido(n, 10, dia=1 + n)])
    totales(spark, carpeta, run_ts, salida, tmp_path / "c1")
    assert suma(spark, salida) == 40
    llegar(carpeta, 4, [pedido(4, 10, 9000)])
    with pytest.raises(ValueError, match="another checkpoint"):
        totales(spark, carpeta, run_ts, salida, tmp_path / "c2")
    assert suma(spark, salida) == 40
    totales(spark, carpeta, run_ts, salida, tmp_path / "c2", reemplazar=True)
    assert suma(spark, salida) == 130


def test_only_changed_groups_are_written_and_merged_in_time(spark, run_ts, tmp_path):
    carpeta, salida = tmp_path / "eventos", tmp_path / "totales"
    for n in range(9):
        llegar(carpeta, n, [pedido(n, 10, dia=1 + n % 3)])
    totales(spark, carpeta, run_ts, salida, tmp_path / "c", junta_cada=4)
    lotes = {int(p.name.rpartition("=")[2]): p for p in Path(salida).glob("origen=*/lote=*")}
    assert set(lotes) == {4, 5, 6, 7, 8}  # 3 and what it had merged went with the merge in 7
    filas = {n: spark.read.parquet(str(p)).count() for n, p in lotes.items()}
    assert filas == {4: 1, 5: 1, 6: 1, 7: 3, 8: 1}
    vistos = {f["fecha"].day: float(f["ventas_totales"]) for f in stateful.leer_totales(spark, str(salida)).collect()}
    assert vistos == {1: 30.0, 2: 30.0, 3: 30.0}
    assert stateful.leer_totales(spark, str(salida), ["2025-05"]).collect() == []
    assert stateful.leer_totales(spark, str(salida), ["2025-04"]).count() == 3
