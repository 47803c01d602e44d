"""Retail lakehouse pipelines on Spark: Bronze feeds to clean Silver tables and Gold aggregates."""

from lonja.contracts import (
    CONTEOS_FISICOS,
    FUENTES,
    INVENTARIO_ERP,
    VENTAS_ECOMMERCE,
    VENTAS_TIENDAS,
    Fuente,
)
from lonja.operators.conform import clasificar, mask_pii, rechazar_vacios, validar_no_vacios
from lonja.operators.dedup import deduplicar
from lonja.operators.quality import log_quality
from lonja.plans.gold import procesar_gold, ventas_consolidadas
from lonja.plans.silver import (
    procesar_silver,
    reprocesar,
    transformar,
    transformar_inventario,
    transformar_ventas_ecommerce,
    transformar_ventas_tiendas,
    unificar,
)
from lonja.sources.bronze import leer_bronze
from lonja.sources.lake import escribir_silver, leer_silver

__all__ = [
    "CONTEOS_FISICOS",
    "FUENTES",
    "INVENTARIO_ERP",
    "VENTAS_ECOMMERCE",
    "VENTAS_TIENDAS",
    "Fuente",
    "clasificar",
    "deduplicar",
    "escribir_silver",
    "leer_bronze",
    "leer_silver",
    "log_quality",
    "mask_pii",
    "procesar_gold",
    "procesar_silver",
    "rechazar_vacios",
    "reprocesar",
    "transformar",
    "transformar_inventario",
    "transformar_ventas_ecommerce",
    "transformar_ventas_tiendas",
    "unificar",
    "validar_no_vacios",
    "ventas_consolidadas",
]
