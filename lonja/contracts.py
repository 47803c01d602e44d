"""Canonical schemas and the declarative description of every feed.

A feed (`Fuente`) says how a raw Bronze table becomes a canonical Silver table: which source column
feeds which canonical column, which values are constant, in which zone and unit the source reports,
and which columns identify a row. The plans in `lonja.plans` are generic over it, so a new feed is one
more `Fuente`, not one more pipeline.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql.types import (
    DecimalType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
    TimestampType,
)


@dataclass(frozen=True)
class Fuente:
    """One feed: how `bronze/<tabla>` turns into the Silver table `destino`."""

    tabla: str
    destino: str
    bronze: StructType
    contrato: StructType
    columnas: Mapping[str, str]  # canonical column -> source column
    requeridas: tuple[str, ...]  # canonical columns that must not be blank
    llave: tuple[str, ...]  # one row survives per key
    orden: tuple[str, ...]  # newest first, then tie-breaks; all other columns follow
    constantes: Mapping[str, str | None] = field(default_factory=dict)
    zonas: Mapping[str, str | Column] = field(default_factory=dict)  # local timestamps; UTC if absent
    sku_sin_espacios: bool = False  # also remove blanks inside skus
    centavos: tuple[str, ...] = ()  # money reported in minor units
    pii: tuple[str, ...] = ()  # hashed before anything is written
    monto: str | None = None  # must be positive; negative means a return
    cantidad: str | None = None  # must be positive
    stock: tuple[str, str] | None = None  # source columns (on hand, reserved)

    @property
    def etiqueta(self) -> str:
        return f"bronze/{self.tabla}"


# --- fixed values: canonical contracts, feed columns, rename maps, labels, zones --------------------

VENTAS = StructType([
    StructField("venta_id", StringType(), False),
    StructField("canal", StringType(), False),
    StructField("tienda_id", StringType(), True),
    StructField("tienda_nombre", StringType(), True),
    StructField("sku", StringType(), False),
    StructField("cantidad", IntegerType(), False),
    StructField("precio_unitario", DecimalType(10, 2), False),
    StructField("monto_total", DecimalType(12, 2), False),
    StructField("moneda", StringType(), False),
    StructField("vendido_en", TimestampType(), False),
    StructField("cliente_id", StringType(), True),
    StructField("_fuente", StringType(), False),
    StructField("_procesado_en", TimestampType(), False),
])

INVENTARIO = StructType([
    StructField("inventario_id", StringType(), False),
    StructField("tienda_id", StringType(), False),
    StructField("tienda_nombre", StringType(), True),
    StructField("sku", StringType(), False),
    StructField("stock_disponible", IntegerType(), False),
    StructField("stock_reservado", IntegerType(), False),
    StructField("ultima_actualizacion", TimestampType(), False),
    StructField("_fuente", StringType(), False),
    StructField("_procesado_en", TimestampType(), False),
])

CONTEOS = StructType([
    StructField("conteo_id", StringType(), False),
    StructField("tienda_id", StringType(), False),
    StructField("sku", StringType(), False),
    StructField("contado", IntegerType(), False),
    StructField("contado_en", TimestampType(), False),
    StructField("_fuente", StringType(), False),
    StructField("_procesado_en", TimestampType(), False),
])

BRONZE_TIENDAS = StructType([
    StructField("id_transaccion", StringType()),
    StructField("codigo_tienda", StringType()),
    StructField("nombre_tienda", StringType()),
    StructField("codigo_producto", StringType()),
    StructField("qty", DoubleType()),
    StructField("precio", DoubleType()),
    StructField("total", DoubleType()),
    StructField("fecha_hora_venta", TimestampNTZType()),
    StructField("id_cliente", LongType()),
])

BRONZE_ECOMMERCE = StructType([
    StructField("order_id", StringType()),
    StructField("product_sku", StringType()),
    StructField("quantity", LongType()),
    StructField("unit_price", LongType()),
    StructField("total_amount", LongType()),
    StructField("created_at", TimestampNTZType()),
    StructField("customer_email", StringType()),
])

BRONZE_INVENTARIO = StructType([
    StructField("inv_id", StringType()),
    StructField("store_code", StringType()),
    StructField("store_name", StringType()),
    StructField("product_code", StringType()),
    StructField("qty_on_hand", DoubleType()),
    StructField("qty_reserved", IntegerType()),
    StructField("last_updated", TimestampNTZType()),
])

BRONZE_CONTEOS = StructType([
    StructField("count_id", StringType()),
    StructField("store_code", StringType()),
    StructField("product_code", StringType()),
    StructField("counted_qty", DoubleType()),
    StructField("counted_at", TimestampNTZType()),
])

ZONA_MEXICO = "America/Mexico_City"
CORRUPTO = "_corrupt_record"
ORDEN_VENTAS = ("vendido_en", "sku", "monto_total", "tienda_id", "precio_unitario", "cantidad", "cliente_id")

VENTAS_TIENDAS = Fuente(
    tabla="ventas_tiendas",
    destino="ventas",
    bronze=BRONZE_TIENDAS,
    contrato=VENTAS,
    columnas={
        "venta_id": "id_transaccion",
        "tienda_id": "codigo_tienda",
        "tienda_nombre": "nombre_tienda",
        "sku": "codigo_producto",
        "cantidad": "qty",
        "precio_unitario": "precio",
        "monto_total": "total",
        "vendido_en": "fecha_hora_venta",
        "cliente_id": "id_cliente",
    },
    constantes={"canal": "tienda_fisica", "moneda": "MXN"},
    requeridas=("venta_id", "sku", "tienda_id"),
    llave=("venta_id",),
    orden=ORDEN_VENTAS,
    zonas={"vendido_en": ZONA_MEXICO},
    pii=("cliente_id",),
    monto="monto_total",
    cantidad="cantidad",
)

VENTAS_ECOMMERCE = Fuente(
    tabla="ventas_ecommerce",
    destino="ventas",
    bronze=BRONZE_ECOMMERCE,
    contrato=VENTAS,
    columnas={
        "venta_id": "order_id",
        "sku": "product_sku",
        "cantidad": "quantity",
        "precio_unitario": "unit_price",
        "monto_total": "total_amount",
        "vendido_en": "created_at",
        "cliente_id": "customer_email",
    },
    constantes={"canal": "ecommerce", "tienda_id": None, "tienda_nombre": None, "moneda": "MXN"},
    requeridas=("venta_id", "sku"),
    llave=("venta_id",),
    orden=ORDEN_VENTAS,
    centavos=("precio_unitario", "monto_total"),
    pii=("cliente_id",),
    monto="monto_total",
    cantidad="cantidad",
)

INVENTARIO_ERP = Fuente(
    tabla="inventario",
    destino="inventario",
    bronze=BRONZE_INVENTARIO,
    contrato=INVENTARIO,
    columnas={
        "inventario_id": "inv_id",
        "tienda_id": "store_code",
        "tienda_nombre": "store_name",
        "sku": "product_code",
        "stock_reservado": "qty_reserved",
        "ultima_actualizacion": "last_updated",
    },
    stock=("qty_on_hand", "qty_reserved"),
    requeridas=("inventario_id", "tienda_id", "sku"),
    llave=("tienda_id", "sku"),
    orden=("ultima_actualizacion", "inventario_id", "stock_disponible", "stock_reservado"),
    zonas={"ultima_actualizacion": ZONA_MEXICO},
)

CONTEOS_FISICOS = Fuente(
    tabla="conteos_fisicos",
    destino="conteos",
    bronze=BRONZE_CONTEOS,
    contrato=CONTEOS,
    columnas={
        "conteo_id": "count_id",
        "tienda_id": "store_code",
        "sku": "product_code",
        "contado": "counted_qty",
        "contado_en": "counted_at",
    },
    requeridas=("conteo_id", "tienda_id", "sku"),
    llave=("tienda_id", "sku"),
    orden=("contado_en", "conteo_id", "contado"),
    zonas={"contado_en": ZONA_MEXICO},
)

# --- end of fixed values ---------------------------------------------------------------------------

FUENTES = {f.tabla: f for f in (VENTAS_TIENDAS, VENTAS_ECOMMERCE, INVENTARIO_ERP, CONTEOS_FISICOS)}
