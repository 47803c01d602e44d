"""Column expressions shared by all feeds. Built-ins only, so they stay inside code generation."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType


def normalizar_sku(c: Column, *, sin_espacios: bool = False) -> Column:
    """Upper case without edge spaces; `sin_espacios` also removes every inner blank."""
    texto = c.cast("string")
    return F.upper(F.regexp_replace(texto, r"\s+", "") if sin_espacios else F.trim(texto))


def no_vacio(c: Column) -> Column:
    """Never NULL, so it can be negated safely."""
    return c.isNotNull() & (F.trim(c.cast("string")) != "")


def a_utc(c: Column, zona: str | Column | None = None) -> Column:
    """Wall-clock time in `zona` (a name or a column; UTC if omitted) to an instant. Needs a UTC session."""
    instante = c.try_cast("timestamp")
    return F.to_utc_timestamp(instante, zona) if zona is not None else instante


def entero(c: Column, *, es_texto: bool = False) -> Column:
    """Whole part of a number. Text goes through an exact decimal: '29.0' is not an integer literal."""
    return (c.try_cast("decimal(38,18)") if es_texto else c).try_cast("int")


def dinero(c: Column, tipo: DecimalType, *, centavos: bool = False) -> Column:
    """Exact decimal, NULL where the value does not fit; minor units are scaled without doubles."""
    if not centavos:
        return c.try_cast(tipo)
    menor = c.try_cast(DecimalType(tipo.precision + 2, 2))
    return (menor * F.lit(Decimal("0.01"))).try_cast(tipo)


def existencias_netas(a_mano: Column, reservado: Column) -> Column:
    """On hand minus reserved; NULL when either is unknown. Doubles cannot overflow like ints do."""
    return a_mano.try_cast("double") - reservado.try_cast("double")


def existencias_disponibles(netas: Column) -> Column:
    """Clamped at zero. An unknown difference also counts as zero stock."""
    return F.greatest(netas, F.lit(0.0)).try_cast("int")


def huella(c: Column, *, sal: str | None = None, normalizar: bool = False) -> Column:
    """SHA-256 in hex, NULL for NULL; optionally salted and case/space-insensitive."""
    texto = c.cast("string")
    if normalizar:
        texto = F.lower(F.trim(texto))
    if sal is not None:
        texto = F.concat(F.lit(sal), texto)
    return F.sha2(texto, 256)


def fecha_negocio(c: Column, zona: str | None = None) -> Column:
    """Calendar date of an instant, in UTC or in a business zone."""
    return F.to_date(F.from_utc_timestamp(c, zona) if zona else c)
