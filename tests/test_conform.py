"""Hand-made rows through typing, classification and completion."""

from __future__ import annotations

import hashlib
from dataclasses import replace
from datetime import datetime
from decimal import Decimal
from itertools import product

import pytest
from pyspark.sql import functions as F

from lonja.contracts import (
    BRONZE_ECOMMERCE,
    BRONZE_INVENTARIO,
    BRONZE_TIENDAS,
    INVENTARIO_ERP,
    VENTAS_TIENDAS,
)
from lonja.operators.conform import clasificar, completar, mask_pii, rechazar_vacios, validar_no_vacios, validas
from lonja.plans import silver
from lonja.sources.bronze import esquema_texto

VENTA = {
    "id_transaccion": "v1",
    "codigo_tienda": "T1",
    "nombre_tienda": "Tienda 1",
    "codigo_producto": " sku-1 ",
    "qty": 2.0,
    "precio": 10.0,
    "total": 20.0,
    "fecha_hora_venta": datetime(2023, 7, 1),
    "id_cliente": 7,
}


def tiendas(spark, *cambios, esquema=BRONZE_TIENDAS):
    filas = [{**VENTA, "id_transaccion": f"v{i}", **c} for i, c in enumerate(cambios)]
    return spark.createDataFrame(filas, esquema)


def textos(spark, *cambios):
    comunes = {k: None if v is None else str(v) for k, v in VENTA.items()}
    filas = [{**comunes, "id_transaccion": f"v{i}", "_corrupt_record": None, **c} for i, c in enumerate(cambios)]
    return spark.createDataFrame(filas, esquema_texto(VENTAS_TIENDAS))


def por_id(df, run_ts):
    completo = completar(clasificar(df, VENTAS_TIENDAS), VENTAS_TIENDAS, run_ts)
    return {f["venta_id"]: f for f in completo.collect()}


@pytest.mark.parametrize("sku", [None, "", "   "])
def test_blank_sku_is_rejected_with_reason(spark, run_ts, sku):
    fila = por_id(tiendas(spark, {"codigo_producto": sku}), run_ts)["v0"]
    assert (fila["_clase"], fila["_motivos"]) == ("rechazo", ["vacio:sku"])


def test_sku_loses_edge_spaces_only(spark):
    df = tiendas(spark, {"codigo_producto": " a b\t "})
    assert validas(df, VENTAS_TIENDAS).first()["sku"] == "A B\t"
    estricta = replace(VENTAS_TIENDAS, sku_sin_espacios=True)
    assert validas(df, estricta).first()["sku"] == "AB"


@pytest.mark.parametrize(
    ("cambio", "clase", "motivos"),
    [
        ({}, "valida", []),
        ({"total": -5.0}, "devolucion", ["monto_no_positivo"]),
        ({"total": -5.0, "qty": 0.0}, "devolucion", ["monto_no_positivo", "cantidad_no_positiva"]),
        ({"total": 0.0}, "rechazo", ["monto_no_positivo"]),
        ({"total": None}, "rechazo", ["nulo:monto_total"]),
        ({"qty": -1.0}, "rechazo", ["cantidad_no_positiva"]),
        ({"qty": None}, "rechazo", ["nulo:cantidad"]),
        ({"total": 1e12}, "rechazo", ["tipo:monto_total"]),
        ({"precio": None}, "rechazo", ["nulo:precio_unitario"]),
        ({"fecha_hora_venta": None}, "rechazo", ["nulo:vendido_en"]),
        ({"total": -5.0, "codigo_tienda": " "}, "rechazo", ["vacio:tienda_id", "monto_no_positivo"]),
        ({"nombre_tienda": None, "id_cliente": None}, "valida", []),
    ],
)
def test_classes_and_reasons(spark, run_ts, cambio, clase, motivos):
    fila = por_id(tiendas(spark, cambio), run_ts)["v0"]
    assert (fila["_clase"], fila["_motivos"]) == (clase, motivos)


def test_text_feed_converts_and_names_bad_columns(spark, run_ts):
    df = textos(
        spark,
        {},
        {"qty": "abc"},
        {"total": "12,5"},
        {"fecha_hora_venta": "ayer"},
        {"_corrupt_record": "{rota"},
        {"qty": "2.9", "total": "1.5E1"},
    )
    filas = por_id(df, run_ts)
    assert filas["v0"]["cantidad"] == 2 and filas["v0"]["vendido_en"] == datetime(2023, 7, 1, 6)
    assert filas["v1"]["_motivos"] == ["tipo:cantidad"]
    assert filas["v2"]["_motivos"] == ["tipo:monto_total"]
    assert filas["v3"]["_motivos"] == ["tipo:vendido_en"]
    assert filas["v4"]["_motivos"] == ["registro_corrupto"]
    assert filas["v5"]["cantidad"] == 2 and filas["v5"]["monto_total"] == Decimal("15.00")
    assert validas(df, VENTAS_TIENDAS).count() == 2


def test_filters_agree_with_reasons(spark):
    """The pushed-down predicates and the reasons are two spellings of one rule set."""
    valores = {
        "codigo_producto": [None, " ", "x"],
        "codigo_tienda": [None, "T1"],
        "qty": [None, -1.0, 0.0, 1.0, 1e11],
        "precio": [None, 1.0, 1e11],
        "total": [None, -1.0, 0.0, 1.0, 1e13, float("nan")],
        "fecha_hora_venta": [None, datetime(2023, 1, 1)],
    }
    df = tiendas(spark, *[dict(zip(valores, v, strict=True)) for v in product(*valores.values())])
    marcadas = clasificar(df, VENTAS_TIENDAS)
    assert marcadas.where((F.col("_clase") == "valida") != (F.col("_faltas") == 0)).count() == 0
    n = {f["_clase"]: f["count"] for f in marcadas.groupBy("_clase").count().collect()}
    assert n["valida"] == validas(df, VENTAS_TIENDAS).count() == 1
    ts = datetime(2025, 1, 1)
    assert n["devolucion"] == silver.devoluciones(df, VENTAS_TIENDAS, ts).count() > 0
    assert n["rechazo"] == silver.rechazos(df, VENTAS_TIENDAS, ts).count()
    assert sum(n.values()) == df.count()


@pytest.mark.parametrize(
    ("local", "utc"),
    [
        (datetime(2022, 7, 1), datetime(2022, 7, 1, 5)),
        (datetime(2023, 7, 1), datetime(2023, 7, 1, 6)),
        (datetime(1997, 4, 6, 2, 30), datetime(1997, 4, 6, 8, 30)),  # does not exist on the clock
        (datetime(1997, 10, 26, 1, 30), datetime(1997, 10, 26, 6, 30)),  # exists twice
    ],
)
def test_local_time_to_utc(spark, local, utc):
    assert validas(tiendas(spark, {"fecha_hora_venta": local}), VENTAS_TIENDAS).first()["vendido_en"] == utc


def test_zone_can_come_from_a_column(spark):
    df = tiendas(spark, {"codigo_tienda": "T1"}, {"codigo_tienda": "T2"}).withColumn(
        "zona", F.when(F.col("codigo_tienda") == "T1", "America/Mexico_City").otherwise("America/Tijuana")
    )
    fuente = replace(VENTAS_TIENDAS, zonas={"vendido_en": F.col("zona")})
    horas = {f["tienda_id"]: f["vendido_en"].hour for f in validas(df, fuente).collect()}
    assert horas == {"T1": 6, "T2": 7}


def test_minor_units_and_masking(spark, run_ts):
    filas = [
        ("o1", "a", 1, 12345, 12345, datetime(2024, 1, 1), "ana@example.com"),
        ("o2", "a", 1, 1, 1, datetime(2024, 1, 1), None),
    ]
    df = silver.transformar_ventas_ecommerce(spark.createDataFrame(filas, BRONZE_ECOMMERCE), run_ts)
    uno, dos = df.orderBy("venta_id").collect()
    assert uno["precio_unitario"] == Decimal("123.45") and dos["monto_total"] == Decimal("0.01")
    assert uno["cliente_id"] == hashlib.sha256(b"ana@example.com").hexdigest()
    assert dos["cliente_id"] is None and uno["tienda_id"] is None


def test_contract_is_exact_and_drops_the_rest(spark, run_ts):
    df = tiendas(spark, {}).withColumn("vendedor", F.lit("Luis"))
    salida = silver.transformar_ventas_tiendas(df, run_ts)
    assert [(c.name, c.dataType) for c in salida.schema] == [
        (c.name, c.dataType) for c in VENTAS_TIENDAS.contrato
    ]


def test_personal_data_never_leaves_unmasked(spark, run_ts):
    df = tiendas(spark, {"codigo_producto": None, "id_cliente": 99}, {"total": -1.0, "id_cliente": 98})
    filas = silver.rechazos(df, VENTAS_TIENDAS, run_ts).collect()
    filas += silver.devoluciones(df, VENTAS_TIENDAS, run_ts).collect()
    assert {len(f["cliente_id"]) for f in filas} == {64}


def test_stock_clamp_unknown_and_missing(spark, run_ts):
    t = datetime(2024, 1, 1)
    filas = [
        ("i1", "T1", None, "a", 3.0, 9, t),
        ("i2", "T1", None, "b", None, 2, t),
        ("i3", "T1", None, "c", 9.0, 3, t),
        ("i4", "T1", None, "d", 9.0, None, t),
    ]
    df = spark.createDataFrame(filas, BRONZE_INVENTARIO)
    stock = {f["sku"]: f["stock_disponible"] for f in silver.transformar_inventario(df, run_ts).collect()}
    assert stock == {"A": 0, "B": 0, "C": 6}
    assert silver.rechazos(df, INVENTARIO_ERP, run_ts).first()["_motivos"] == ["nulo:stock_reservado"]


def test_blank_check_and_its_complement(spark):
    df = spark.createDataFrame([("a", "x"), (None, "x"), (" ", None), ("b", "")], "k string, v string")
    assert validar_no_vacios(df, ["k", "v"]).count() == 1
    rechazos = {(f["k"], f["v"]): f["_motivos"] for f in rechazar_vacios(df, ["k", "v"]).collect()}
    assert rechazos == {
        (None, "x"): ["vacio:k"],
        (" ", None): ["vacio:k", "vacio:v"],
        ("b", ""): ["vacio:v"],
    }


def test_mask_salt_and_normalisation(spark):
    df = spark.createDataFrame([(" Ana@x.com", 1), ("ana@x.com ", 1)], "correo string, tarjeta int")
    iguales = mask_pii(df, "correo", "tarjeta", sal="s", normalizar=True)
    assert iguales.select("correo").distinct().count() == 1
    assert iguales.first()["correo"] == hashlib.sha256(b"sana@x.com").hexdigest()
    assert mask_pii(df, "correo").select("correo").distinct().count() == 2
