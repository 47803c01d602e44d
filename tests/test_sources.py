from __future__ import annotations

import json
from datetime import date, datetime, timedelta

import pytest
from pyspark.errors import AnalysisException

from lonja.contracts import VENTAS_ECOMMERCE, VENTAS_TIENDAS
from lonja.operators.conform import clasificar, validas
from lonja.operators.quality import log_quality
from lonja.session import particiones_shuffle
from lonja.sources import bronze, incremental
from lonja.workspace import espacio

DIA = date(2025, 4, 13)
PEDIDO = {
    "order_id": "o1",
    "product_sku": "a",
    "quantity": 1,
    "unit_price": 1050,
    "total_amount": 1050,
    "created_at": "2024-01-01T10:00:00.123456",
    "customer_email": "a@x.com",
}
LINEA = "v1,T1,Tienda 1, sku-1 ,2.0,10.0,20.0,2023-07-01 00:00:00,7"


def carpeta(tmp_path, tabla, fecha=DIA):
    c = tmp_path / tabla / f"fecha={fecha}"
    c.mkdir(parents=True)
    return c


def test_json_lines_with_broken_and_odd_rows(spark, tmp_path):
    c = carpeta(tmp_path, "ventas_ecommerce")
    malo = {**PEDIDO, "order_id": "o2", "quantity": "tres"}
    sin_cantidad = {k: v for k, v in PEDIDO.items() if k != "quantity"} | {"order_id": "o3", "extra": [1]}
    lineas = [json.dumps(PEDIDO), '{"order_id": "o9", "prod', json.dumps(malo), json.dumps(sin_cantidad)]
    (c / "a.json").write_text("\n".join(lineas))
    df = bronze.leer_bronze(spark, VENTAS_ECOMMERCE, str(tmp_path), DIA, formato="json")
    buena = validas(df, VENTAS_ECOMMERCE).collect()
    assert [f["venta_id"] for f in buena] == ["o1"]
    assert buena[0]["vendido_en"] == datetime(2024, 1, 1, 10, 0, 0, 123456)
    assert clasificar(df, VENTAS_ECOMMERCE).where("_clase = 'rechazo'").count() == 3


def test_csv_lines_with_too_few_or_too_many_fields(spark, tmp_path):
    c = carpeta(tmp_path, "ventas_tiendas")
    cabecera = ",".join(f.name for f in VENTAS_TIENDAS.bronze)
    (c / "a.csv").write_text("\n".join([cabecera, LINEA, "v2,T1", LINEA.replace("v1", "v3") + ",sobra"]))
    df = bronze.leer_bronze(spark, VENTAS_TIENDAS, str(tmp_path), DIA, formato="csv")
    assert [f["venta_id"] for f in validas(df, VENTAS_TIENDAS).select("venta_id").collect()] == ["v1"]
    rotas = clasificar(df, VENTAS_TIENDAS).where("_corrupto").collect()
    assert {(f["venta_id"], f["_clase"]) for f in rotas} == {("v2", "rechazo"), ("v3", "rechazo")}


def test_csv_with_another_header_is_refused(spark, tmp_path):
    c = carpeta(tmp_path, "ventas_tiendas")
    (c / "a.csv").write_text("codigo_tienda,id_transaccion\nT1,v1\n")
    df = bronze.leer_bronze(spark, VENTAS_TIENDAS, str(tmp_path), DIA, formato="csv")
    with pytest.raises(Exception, match="header"):
        df.collect()


def test_run_dates_are_read_by_folder(spark, tmp_path):
    for i in range(3):
        f = DIA + timedelta(days=i)
        spark.createDataFrame([(f"o{i}",)], "order_id string").write.parquet(
            bronze.ruta_bronze(str(tmp_path), "ventas_ecommerce", f)
        )
    df = bronze.leer_bronze(spark, VENTAS_ECOMMERCE, str(tmp_path), [DIA, DIA + timedelta(days=2)])
    assert {(f["order_id"], f["fecha"]) for f in df.collect()} == {("o0", DIA), ("o2", DIA + timedelta(days=2))}
    assert all("fecha=2025-04-14" not in a for a in df.inputFiles())


def test_missing_folders(spark, tmp_path):
    raiz = str(tmp_path)
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        bronze.leer_bronze(spark, VENTAS_TIENDAS, raiz, DIA)
    for formato in bronze.FORMATOS:
        df = bronze.leer_bronze(spark, VENTAS_TIENDAS, raiz, DIA, formato=formato, permitir_vacio=True)
        assert validas(df, VENTAS_TIENDAS).count() == 0
    spark.createDataFrame([("v1",)], "id_transaccion string").write.parquet(
        bronze.ruta_bronze(raiz, "ventas_tiendas", DIA)
    )
    ambas = [DIA, DIA + timedelta(days=1)]
    assert bronze.leer_bronze(spark, VENTAS_TIENDAS, raiz, ambas, permitir_vacio=True).count() == 1
    with pytest.raises(ValueError, match="formato"):
        bronze.leer_bronze(spark, VENTAS_TIENDAS, raiz, DIA, formato="xml")


def test_incremental_window_and_mark(spark, tmp_path):
    t = datetime(2024, 1, 1)
    tabla = spark.createDataFrame([(i, t + timedelta(hours=i)) for i in range(10)], "order_id int, updated_at timestamp")
    marca, hasta = t + timedelta(hours=3), t + timedelta(hours=7)
    ids = lambda df: sorted(f["order_id"] for f in df.collect())
    assert ids(incremental.extraer_incremental(tabla, "updated_at", marca, hasta=hasta)) == [4, 5, 6, 7]
    assert ids(incremental.extraer_incremental(tabla, "updated_at", None)) == list(range(10))
    con_solape = incremental.extraer_incremental(tabla, "updated_at", marca, hasta=hasta, solape=timedelta(hours=1))
    assert ids(con_solape) == [3, 4, 5, 6, 7]
    vacia = incremental.extraer_incremental(tabla, "updated_at", t + timedelta(days=9))
    assert incremental.nueva_marca(vacia, "updated_at", marca).first()["marca"] == marca
    for _ in range(2):
        nueva = incremental.ingerir(tabla, VENTAS_ECOMMERCE, str(tmp_path), DIA, "updated_at", marca, hasta)
        assert nueva == hasta
    assert incremental.ingerir(tabla, VENTAS_ECOMMERCE, str(tmp_path), DIA, "updated_at", hasta, hasta) == hasta
    assert ids(bronze.leer_bronze(spark, VENTAS_ECOMMERCE, str(tmp_path), DIA)) == [4, 5, 6, 7]


def test_incremental_predicate_reaches_the_scan(spark, sf_dir):
    pedidos = spark.read.parquet(f"{sf_dir}/orders.parquet")
    plan = incremental.extraer_incremental(pedidos, "o_orderdate", datetime(1998, 1, 1))._jdf.queryExecution().toString()
    assert "GreaterThan(o_orderdate," in plan


def test_jdbc_options_split_the_window():
    marca = datetime(2024, 1, 1)
    o = incremental.opciones_jdbc("jdbc:x", "ventas", "updated_at", marca, marca + timedelta(days=1), particiones=4)
    assert (o["partitionColumn"], o["numPartitions"], o["lowerBound"]) == ("updated_at", "4", "2024-01-01 00:00:00")
    with pytest.raises(ValueError, match="window"):
        incremental.opciones_jdbc("jdbc:x", "ventas", "updated_at", marca, marca)


def test_quality_report_looks_at_the_named_columns(spark):
    df = spark.createDataFrame([(None, 1.0), ("a", None), ("b", 2.0)], "codigo string, total double")
    fila = log_quality(df, "bronze_raw", "t", sku="codigo", monto="total").first()
    assert tuple(fila) == ("t", "bronze_raw", 3, 1, 1)
    assert log_quality(df, "x", "t", sku="codigo").first()["nulos_monto"] == 0


def test_workspace_is_under_the_shared_folder(spark):
    ruta = espacio(spark, "prueba")
    assert ruta.startswith(spark.conf.get("spark.checkpoint.dir"))
    assert ruta != espacio(spark, "prueba")


def test_shuffle_sizing():
    assert particiones_shuffle(1) == 200
    assert particiones_shuffle(100 * 1 << 40) == 100 * (1 << 40) // (128 << 20)

