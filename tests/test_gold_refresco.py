"""Gold refreshes that are stopped, come late, are rerun, and what they read."""

from __future__ import annotations

import shutil
from datetime import date, timedelta
from pathlib import Path

import pytest
from pyspark.sql import DataFrameReader, DataFrameWriter
from pyspark.sql import functions as F
from test_entregas import DIA, SOLO, llegan, total
from test_streaming import pedido

from lonja.plans import gold, silver
from lonja.sources import indice

OTRO = DIA + timedelta(days=1)


def entregar(spark, b, s, dia, pedidos):
    llegan(spark, b, pedidos, dia)
    silver.procesar_silver(spark, b, s, dia, fuentes=SOLO)


def contenido(spark, g, tabla="ventas_consolidadas"):
    return sorted(tuple(f) for f in gold.leer_gold(spark, tabla, g).drop("_procesado_en").collect())


def indexado(spark, g):
    return sorted(tuple(f) for f in spark.read.parquet(indice.ruta_indice(g)).select("venta_id", "fecha", "_corrida").collect())


@pytest.fixture
def rutas(tmp_path):
    return [str(tmp_path / n) for n in ("bronze", "silver", "gold")]


def test_a_refresh_stopped_at_any_write_is_finished_by_the_next(spark, rutas, tmp_path, monkeypatch):
    b, s, g = rutas
    entregar(spark, b, s, DIA, [pedido(1, 10), pedido(2, 10), pedido(9, 10, dia=2)])
    gold.procesar_gold(spark, s, g, DIA, detalle=True)
    entregar(spark, b, s, OTRO, [pedido(2, 11, 3000, dia=2), pedido(3, 10)])  # sale 2 moves
    entero = str(tmp_path / "entero")
    gold.procesar_gold(spark, s, entero, [DIA, OTRO], detalle=True)
    escribir, antes = DataFrameWriter.parquet, shutil.copytree(g, str(tmp_path / "antes"))
    tablas = ("ventas_consolidadas", "ventas_vigentes", "ventas_por_tienda_sku_dia")
    corte = hechas = 0
    while hechas == corte:  # the last try has fewer writes than the stop would need
        corte, hechas = corte + 1, 0
        shutil.copytree(antes, tmp_path / f"g{corte}")
        este = str(tmp_path / f"g{corte}")

        def contada(self, *a, **k):
            nonlocal hechas
            hechas += 1
            if hechas == corte:
                raise RuntimeError("stopped")
            return escribir(self, *a, **k)

        monkeypatch.setattr(DataFrameWriter, "parquet", contada)
        try:
            gold.procesar_gold(spark, s, este, OTRO, detalle=True)
        except RuntimeError:
            pass
        monkeypatch.setattr(DataFrameWriter, "parquet", escribir)
        if corte % 3:
            gold.procesar_gold(spark, s, este, OTRO, detalle=True)
        else:  # another run date's refresh finishes what can be finished
            gold.procesar_gold(spark, s, este, DIA, detalle=True)
            gold.procesar_gold(spark, s, este, OTRO, detalle=True)
        for tabla in tablas:
            assert contenido(spark, este, tabla) == contenido(spark, entero, tabla), (corte, tabla)
        assert indexado(spark, este) == indexado(spark, entero)
        assert not list(Path(este, "_pendientes").glob("*"))
    assert corte > 8
    assert {f[1].day: float(f[2]) for f in contenido(spark, este)} == {1: 20.0, 2: 40.0}


def test_a_stop_inside_a_commit_loses_nothing(spark, rutas, monkeypatch):
    b, s, g = rutas
    entregar(spark, b, s, DIA, [pedido(1, 10), pedido(2, 10)])
    gold.procesar_gold(spark, s, g, DIA)
    entregar(spark, b, s, OTRO, [pedido(3, 10)])
    trabajo = gold.preparar_gold(spark, s, g, OTRO)
    shutil.rmtree(Path(g, "ventas_vigentes", "periodo=2025-04-01"))  # deleted, not yet replaced
    gold.reanudar_gold(spark, g)
    assert total(spark, g) == 30 and gold.leer_gold(spark, "ventas_vigentes", g).count() == 3
    assert not Path(trabajo.removeprefix("file:")).exists()
    gold.reanudar_gold(spark, g)
    assert total(spark, g) == 30


def test_an_older_version_that_comes_late_does_not_win(spark, rutas):
    b, s, g = rutas
    entregar(spark, b, s, DIA, [pedido(1, 12, 5000)])
    gold.procesar_gold(spark, s, g, DIA)
    tarde = DIA + timedelta(days=3)
    entregar(spark, b, s, tarde, [pedido(1, 9, 1000)])
    gold.procesar_gold(spark, s, g, tarde, desde=tarde)
    assert total(spark, g) == 50
    gold.procesar_gold(spark, s, g, tarde)
    assert total(spark, g) == 50


def test_a_late_run_date_equals_a_full_rebuild(spark, rutas, tmp_path):
    b, s, g = rutas
    dias = [date(2025, 2, 27) + timedelta(days=i) for i in range(4)]
    for i, dia in enumerate(dias):
        entregar(spark, b, s, dia, [pedido(j, 10 + i % 2, 1000 * (i + 1), dia=1 + j % 3) for j in range(i, i + 4)])
    for dia in (dias[0], dias[2], dias[3], dias[1]):  # the second comes last
        gold.procesar_gold(spark, s, g, dia)
    entero = str(tmp_path / "entero")
    gold.procesar_gold(spark, s, entero, dias)
    assert contenido(spark, g) == contenido(spark, entero) and indexado(spark, g) == indexado(spark, entero)
    # February is closed and lies in one part, March by run date
    assert indice.tramos(spark, g) == {"2025-02": {"mes"}, "2025-03": {"2025-03-01", "2025-03-02"}}
    # a run date of the closed month again, with fewer sales
    b2 = str(tmp_path / "corregido")
    entregar(spark, b2, s, dias[0], [pedido(0, 10, dia=2)])
    gold.procesar_gold(spark, s, g, dias[0])
    entero = str(tmp_path / "otra_vez")
    gold.procesar_gold(spark, s, entero, dias)
    assert contenido(spark, g) == contenido(spark, entero) and indexado(spark, g) == indexado(spark, entero)


def test_gold_without_an_index_gets_one(spark, rutas):
    b, s, g = rutas
    entregar(spark, b, s, DIA, [pedido(1, 10), pedido(2, 10)])
    gold.procesar_gold(spark, s, g, DIA)
    shutil.rmtree(indice.ruta_indice(g))
    entregar(spark, b, s, OTRO, [pedido(2, 11, 3000, dia=2)])
    gold.procesar_gold(spark, s, g, OTRO)
    assert total(spark, g) == 40 and len(indexado(spark, g)) == 3


def test_what_a_refresh_reads_does_not_follow_the_history(spark, rutas, tmp_path, monkeypatch):
    """One redelivered sale and a new one, after 3 and after 12 older run dates of a closed month."""
    leer, leidos = DataFrameReader.parquet, []

    def anotada(self, *rutas, **k):
        df = leer(self, *rutas, **k)
        leidos.append([f for f in df.inputFiles() if "/_pendientes/" not in f])
        return df

    vistos = {}
    for n in (3, 12):
        b, s, g = (str(tmp_path / f"{x}{n}") for x in ("bronze", "silver", "gold"))
        viejos = [date(2025, 3, 2) + timedelta(days=i) for i in range(n)]
        for i, dia in enumerate(viejos):
            llegan(spark, b, [pedido(100 * n + 10 * i + j, 10, dia=1 + i) for j in range(3)] + [pedido(1, 9)][: i == 0], dia)
        silver.reprocesar(spark, b, s, viejos, fuentes=SOLO)
        gold.procesar_gold(spark, s, g, viejos)
        for dia, nueva in ((DIA, pedido(2, 10, dia=13)), (OTRO, pedido(3, 10, dia=14))):
            entregar(spark, b, s, dia, [pedido(1, 12, 2000, dia=13), nueva])
            leidos.clear()
            monkeypatch.setattr(DataFrameReader, "parquet", anotada)
            gold.procesar_gold(spark, s, g, dia)
            monkeypatch.setattr(DataFrameReader, "parquet", leer)
        vistos[n] = {t: len({f for fs in leidos for f in fs if f"/{t}/" in f}) for t in ("ventas", "ventas_vigentes")}
        cubos = len({f for fs in leidos for f in fs if "/indice_ventas/" in f and "/mes=2025-03/" in f})
        assert cubos <= 2  # the closed month's buckets of the two sales
        corridas = {f.split("/silver")[1].split("/day=")[1].split("/")[0] for fs in leidos for f in fs if "/silver" in f}
        assert corridas == {str(OTRO.day)}
    assert vistos[3] == vistos[12] and vistos[12]["ventas_vigentes"] <= 2


def test_a_rerun_reads_other_run_dates_only_for_what_it_takes_back(spark, rutas, tmp_path, monkeypatch):
    b, s, g = rutas
    entregar(spark, b, s, DIA, [pedido(1, 10), pedido(2, 10)])
    entregar(spark, b, s, OTRO, [pedido(1, 11, 2000), pedido(3, 10)])
    gold.procesar_gold(spark, s, g, [DIA, OTRO])
    pedidos = []
    leer_dias = gold.leer_dias
    monkeypatch.setattr(gold, "leer_dias", lambda spark, t, r, dias: pedidos.append(list(dias)) or leer_dias(spark, t, r, dias))
    gold.procesar_gold(spark, s, g, OTRO)
    assert pedidos == [[OTRO]] and total(spark, g) == 40
    b2 = str(tmp_path / "corregido")
    entregar(spark, b2, s, OTRO, [pedido(3, 10)])
    pedidos.clear()
    gold.procesar_gold(spark, s, g, OTRO)
    assert pedidos == [[OTRO], [DIA]] and total(spark, g) == 30
    assert gold.leer_gold(spark, "ventas_vigentes", g).where(F.col("venta_id") == "o1").first()["_corrida"] == DIA


def test_a_first_refresh_writes_its_sales_once(spark, rutas, monkeypatch):
    b, s, g = rutas
    entregar(spark, b, s, DIA, [pedido(1, 10), pedido(2, 10), pedido(9, 10, dia=2)])
    escribir, escritas = DataFrameWriter.parquet, []
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda self, ruta, **k: escritas.append(ruta) or escribir(self, ruta, **k))
    gold.procesar_gold(spark, s, g, DIA)
    monkeypatch.setattr(DataFrameWriter, "parquet", escribir)
    assert sorted(r.rpartition("/")[2] for r in escritas) == ["indice", "ventas_consolidadas", "ventas_vigentes"]
    assert gold.leer_gold(spark, "ventas_vigentes", g).count() == 3 and len(indexado(spark, g)) == 3


@pytest.mark.parametrize("movidas", [False, True])
def test_a_run_date_that_loses_all_its_sales_empties_their_periods(spark, rutas, tmp_path, movidas):
    b, s, g = rutas
    entregar(spark, b, s, DIA, [pedido(1, 10)])
    entregar(spark, b, s, OTRO, [pedido(2, 10, dia=2)])
    gold.procesar_gold(spark, s, g, [DIA, OTRO])
    entregar(spark, str(tmp_path / "corregido"), s, OTRO, [pedido(2, 10, -1000, dia=2)])
    trabajo = gold.preparar_gold(spark, s, g, OTRO)
    if movidas:  # stopped between two steps
        gold.escribir_vigentes(spark, g, trabajo)
    gold.reanudar_gold(spark, g)
    assert [f[1] for f in indexado(spark, g)] == [date(2025, 4, 1)]
    assert [f[1] for f in contenido(spark, g)] == [date(2025, 4, 1)]
    assert gold.leer_gold(spark, "ventas_vigentes", g).count() == 1
    assert gold.leer_gold(spark, "ventas_vigentes", g, ["2025-04-02"]).count() == 0
