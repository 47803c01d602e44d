"""As-of joins, versions, levels, sketches and events that grow, on small hand-made rows."""

from __future__ import annotations

import random
from collections import Counter
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F
from test_streaming import aterrizar, pedido

from lonja.contracts import VENTAS_ECOMMERCE
from lonja.operators import bosquejos
from lonja.operators.temporal import al_momento, con_version, versiones_dimension
from lonja.plans import gold
from lonja.plans.queries import silver_ventas
from lonja.sources import bronze, lake
from lonja.streaming import microbatch

T0 = datetime(2025, 1, 1)
HECHOS = "n int, tienda string, sku string, t timestamp, _valor string"
VERSIONES = "id int, tienda string, sku string, desde timestamp, stock int, nota string"


def minutos(n):
    return None if n is None else T0 + timedelta(minutes=n)


def vigente(versiones, tienda, sku, t):
    """(stock, nota) by looking at every version."""
    valen = [v for v in versiones if tienda and sku and t is not None and v[3] is not None and v[1:3] == (tienda, sku) and v[3] <= t]
    mejor = max(valen, key=lambda v: (v[3], v[0]), default=None)
    return mejor[4:] if mejor else (None, None)


@pytest.mark.parametrize("particiones", [1, 2, 7, 40])
def test_each_fact_meets_the_version_of_its_time(spark, particiones):
    azar = random.Random(particiones)
    # one key has two thirds of all rows, another none of the versions
    llave = lambda: azar.choice([("T1", "A")] * 6 + [("T1", "B"), ("T2", "A"), ("T2", "B")])
    versiones = [(i, *llave(), minutos(azar.randrange(50)), azar.choice([None, i]), None if i % 5 else "x") for i in range(60)]
    versiones += [(100, "T1", "A", None, 1, "x"), (101, None, "A", T0, 2, "x"), (102, "T1", "A", minutos(3), 3, "x")]
    hechos = [(i, *llave(), minutos(azar.randrange(-5, 55)), "own") for i in range(150)]
    hechos += [(200, "T9", "A", minutos(9), None), (201, "T1", None, minutos(9), None), (202, None, "A", minutos(9), None)]
    hechos += [(203, "T1", "A", None, None)] + [(204, "T1", "A", minutos(3), None)] * 20
    df, vs = spark.createDataFrame(hechos, HECHOS), spark.createDataFrame(versiones, VERSIONES)
    visto = al_momento(
        df, vs, ("tienda", "sku"), tiempo="t", desde="desde", valores=("stock", "nota"), desempate=("id",), particiones=particiones
    )
    assert visto.columns == [*df.columns, "stock", "nota"]
    esperado = Counter((*h, *vigente(versiones, *h[1:4])) for h in hechos)
    assert Counter(map(tuple, visto.collect())) == esperado
    assert sum(n for f, n in esperado.items() if f[5] is not None) > 50


def test_as_of_without_versions_or_facts(spark):
    df, vs = spark.createDataFrame([(1, "T", "A", T0, "v")], HECHOS), spark.createDataFrame([], VERSIONES)
    opciones = {"tiempo": "t", "desde": "desde", "valores": ("stock",)}
    assert al_momento(df, vs, ("tienda", "sku"), **opciones).collect() == [(1, "T", "A", T0, "v", None)]
    uno = spark.createDataFrame([(1, "T", "A", T0, 5, "x")], VERSIONES)
    assert al_momento(df.where("false"), uno, ("tienda", "sku"), **opciones).collect() == []
    assert al_momento(df, uno, ("tienda", "sku"), **opciones).first()["stock"] == 5


def test_facts_keep_their_own_types_and_only_versions_are_sorted_for_the_borders(spark, tmp_path):
    df = spark.createDataFrame([(7, T0.date()), (None, T0.date())], "llave int, dia date")
    vs = spark.createDataFrame([(7, T0, 5), (8, T0, 6)], "llave long, desde timestamp, stock int")
    visto = al_momento(df, vs, ("llave",), tiempo="dia", desde="desde", valores=("stock",), particiones=3)
    assert visto.dtypes == [("llave", "int"), ("dia", "date"), ("stock", "int")]
    assert sorted(visto.collect(), key=str) == [(7, T0.date(), 5), (None, T0.date(), None)]
    solo = spark.createDataFrame([(7, T0)], "llave long, t timestamp")  # nothing but keys and time
    visto = al_momento(solo, vs, ("llave",), tiempo="t", desde="desde", valores=("stock",), particiones=3)
    assert visto.collect() == [(7, T0, 5)]
    plan = visto._jdf.queryExecution().executedPlan().toString()
    bordes = next(línea for línea in plan.split("SortAggregate")[-1].splitlines() if "PushedFilters" in línea)
    assert "EqualTo(_tipo,0)" in bordes


def test_a_name_that_comes_back_is_a_stretch_of_its_own(spark):
    dia = lambda n, h=0: datetime(2025, 3, n, h)
    filas = [
        ("T1", "Centro", dia(1)), ("T1", "Centro", dia(2)), ("T1", "Norte", dia(5, 9)), ("T1", "Norte", dia(6)),
        ("T1", "Centro", dia(5, 8)), ("T1", "Centro", dia(9)), ("T2", None, dia(1)), ("T2", "Sur", dia(4)),
        (None, "x", dia(1)), ("T3", "y", None),
    ]
    observadas = spark.createDataFrame(filas, "tienda_id string, tienda_nombre string, t timestamp")
    tiendas = versiones_dimension(observadas, "tienda_id", ("tienda_nombre",), tiempo="t")
    d = lambda n: date(2025, 3, n)
    assert sorted(map(tuple, tiendas.collect()), key=str) == sorted([
        ("T1", "Centro", d(1), d(5)), ("T1", "Norte", d(5), d(9)), ("T1", "Centro", d(9), None),
        ("T2", None, d(1), d(4)), ("T2", "Sur", d(4), None),
    ], key=str)
    hechos = spark.createDataFrame(
        [(1, "T1", d(1)), (2, "T1", d(4)), (3, "T1", d(5)), (4, "T1", d(30)), (5, "T1", date(2025, 2, 1)), (6, None, d(5)), (7, "T9", d(5))],
        "n int, tienda_id string, fecha date",
    )
    nombres = {f["n"]: f["tienda_nombre"] for f in con_version(hechos, tiendas, "tienda_id", "fecha").collect()}
    assert nombres == {1: "Centro", 2: "Centro", 3: "Norte", 4: "Centro", 5: None, 6: None, 7: None}


def test_all_levels_take_one_scan_and_one_exchange(spark, sf_dir, tmp_path):
    silver_ventas(spark, sf_dir).write.parquet(str(tmp_path / "ventas"))
    ventas = spark.read.parquet(str(tmp_path / "ventas"))
    plan = gold.ventas_por_niveles(ventas)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Exchange") == 1
    assert "venta_id" not in plan.split("ReadSchema")[1]
    gold.escribir_niveles(ventas, str(tmp_path / "gold"))
    leidas = spark.read.parquet(str(tmp_path / "gold" / "ventas_por_niveles"))
    total = leidas.where("nivel = 'total'").first()
    assert total["n_ventas"] == ventas.count() and (total["tienda_id"], total["sku"], total["fecha"]) == (None,) * 3
    for nivel in gold.NIVELES:
        assert leidas.where(F.col("nivel") == nivel).agg(F.sum("n_ventas")).first()[0] == total["n_ventas"]
    assert gold.escribir_niveles(ventas.where("false"), str(tmp_path / "gold")) == 0  # without sales no total either
    assert spark.read.parquet(str(tmp_path / "gold" / "ventas_por_niveles")).count() == 0


def test_a_range_of_dates_reads_sketches_only(spark, tmp_path):
    raiz, dias = str(tmp_path), [date(2025, 4, 1) + timedelta(days=i) for i in range(4)]
    for i, dia in enumerate(dias):
        filas = spark.range(20_000 * i, 20_000 * i + 30_000).selectExpr("CAST(id AS string) AS v", "concat('s', id % (3 + id % 4)) AS s")
        bosquejos.escribir_bosquejos(bosquejos.bosquejar(filas, distintos="v", frecuentes="s"), "b", raiz, dia)
    bosquejos.escribir_bosquejos(bosquejos.bosquejar(filas, distintos="v", frecuentes="s"), "b", raiz, dias[3])  # again
    for desde, hasta, reales, n in ((0, 0, 30_000, 30_000), (0, 1, 50_000, 60_000), (1, 3, 70_000, 90_000), (0, 3, 90_000, 120_000)):
        cuenta = bosquejos.contar_distintos(spark, "b", raiz, dias[desde], dias[hasta])
        assert len(cuenta.inputFiles()) == hasta - desde + 1
        fila = cuenta.first()
        assert fila["filas"] == n and abs(fila["distintos"] - reales) <= reales * bosquejos.margen()
    frecuentes = bosquejos.mas_frecuentes(spark, "b", raiz, dias[0], dias[1], 2).collect()
    exactas = Counter(f"s{i % (3 + i % 4)}" for d in (0, 1) for i in range(20_000 * d, 20_000 * d + 30_000))
    assert {(f["valor"], f["veces"]) for f in frecuentes} == set(exactas.most_common(2))
    assert bosquejos.contar_distintos(spark, "b", raiz, "2030-01-01", "2030-01-02", por=()).first()["filas"] is None


def test_unknown_fields_are_kept_as_they_came(spark, tmp_path):
    lineas = [
        '{"order_id": "a", "quantity": 2}',
        '{"order_id": "b", "cupon": 7, "envio": {"zona": ["x", "y"]}, "ORDER_ID": "other"}',
        '{"order_id": "c", "cupon": "siete", "nulo": null}',
        '{"order_id": "d", "cup',
        "[1]",
        '{"order_id": 5, "grande": 12345678901234567890, "punto.y$": true}',
    ]
    df = bronze.abrir_json(spark.createDataFrame([(x, i) for i, x in enumerate(lineas)], "value string, n int"), VENTAS_ECOMMERCE)
    df.write.parquet(str(tmp_path / "b"))
    leido = spark.read.parquet(str(tmp_path / "b"))
    filas = {f["n"]: f for f in leido.withColumns({
        "cupon": bronze.recuperar("cupon", "int"), "texto": bronze.recuperar("cupon", "string"),
        "zona": bronze.recuperar("envio", "string", ruta="$.zona[1]"), "otro": bronze.recuperar("ORDER_ID", "string"),
        "grande": bronze.recuperar("grande", "decimal(20,0)"), "punto": bronze.recuperar("punto.y$", "boolean"),
    }).drop("_otros").collect()}
    assert [filas[i]["order_id"] for i in range(6)] == ["a", "b", "c", None, None, "5"]
    assert filas[0]["quantity"] == "2" and filas[0]["cupon"] is None
    assert (filas[1]["cupon"], filas[1]["zona"], filas[1]["otro"]) == (7, "y", "other")
    assert (filas[2]["cupon"], filas[2]["texto"]) == (None, "siete")
    assert filas[3]["_corrupt_record"] == lineas[3] and filas[4]["_corrupt_record"] == "[1]"
    assert int(filas[5]["grande"]) == 12345678901234567890 and filas[5]["punto"] is True
    campos = {f["campo"]: (f["tipo"], f["filas"]) for f in bronze.campos_nuevos(leido).collect()}
    assert campos["cupon"] == ("VARIANT", 2) and campos["envio"] == ("OBJECT<zona: ARRAY<STRING>>", 1)
    assert set(campos) == {"cupon", "envio", "ORDER_ID", "nulo", "grande", "punto.y$"}


def test_a_field_that_appears_in_the_stream_is_found_in_bronze(spark, tmp_path):
    carpeta, (b, s, c) = tmp_path / "eventos", (str(tmp_path / n) for n in ("bronze", "silver", "c"))
    aterrizar(carpeta, "1.json", [pedido(1, 10)], "2025-04-13 10:00:00")

    def correr():
        flujo = microbatch.leer_eventos_abiertos(spark, VENTAS_ECOMMERCE, str(carpeta), archivos_por_lote=1)
        microbatch.ejecutar_microlotes(flujo, VENTAS_ECOMMERCE, bronze=b, silver=s, checkpoint=c)

    correr()
    aterrizar(carpeta, "2.json", [{**pedido(2, 10), "canal_origen": {"app": "ios"}}], "2025-04-13 11:00:00")
    (carpeta / "3.json").write_text('{"order_id": "o3", "prod\n\n')
    correr()
    crudas = bronze.leer_bronze(spark, VENTAS_ECOMMERCE, b, date(2025, 4, 13), permitir_vacio=True)
    app = {f["order_id"]: f["app"] for f in crudas.select("order_id", bronze.recuperar("canal_origen", "string", ruta="$.app").alias("app")).collect()}
    assert app["o1"] is None and app["o2"] == "ios"
    assert sorted(f["venta_id"] for f in lake.leer_silver(spark, "ventas", s).collect()) == ["o1", "o2"]
