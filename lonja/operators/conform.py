"""Raw feed -> typed canonical columns, and the split into valid rows, returns and rejects."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime
from functools import reduce
from operator import add, and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, IntegerType, StringType, StructField, TimestampType

from lonja.contracts import CORRUPTO, Fuente
from lonja.functions import (
    a_utc,
    dinero,
    entero,
    existencias_disponibles,
    existencias_netas,
    huella,
    no_vacio,
    normalizar_sku,
)

VALIDA, DEVOLUCION, RECHAZO = "valida", "devolucion", "rechazo"
MONTO_NO_POSITIVO, CANTIDAD_NO_POSITIVA = "monto_no_positivo", "cantidad_no_positiva"


def _valor(fuente: Fuente, campo: StructField, tipos: Mapping[str, str]) -> Column:
    crudo = F.col(fuente.columnas[campo.name])
    if campo.name == "sku":
        return normalizar_sku(crudo, sin_espacios=fuente.sku_sin_espacios)
    if isinstance(campo.dataType, DecimalType):
        return dinero(crudo, campo.dataType, centavos=campo.name in fuente.centavos)
    if isinstance(campo.dataType, TimestampType):
        return a_utc(crudo, fuente.zonas.get(campo.name))
    if isinstance(campo.dataType, IntegerType):
        return entero(crudo, es_texto=tipos[fuente.columnas[campo.name]] == "string")
    return crudo.cast(campo.dataType)


def reglas(fuente: Fuente) -> list[str]:
    """Names of the rules a row of the feed can break. The position is the bit in `_faltas`."""
    nombres = ["registro_corrupto", *(f"vacio:{c}" for c in fuente.requeridas)]
    for campo in fuente.contrato:
        derivada = campo.name == "stock_disponible" and fuente.stock is not None
        if campo.name in fuente.requeridas or not (derivada or campo.name in fuente.columnas):
            continue
        if not derivada and not isinstance(campo.dataType, StringType):
            nombres.append(f"tipo:{campo.name}")
        if not campo.nullable:
            nombres.append(f"nulo:{campo.name}")
    nombres += [m for c, m in ((fuente.monto, MONTO_NO_POSITIVO), (fuente.cantidad, CANTIDAD_NO_POSITIVA)) if c]
    return nombres


def _incumple(regla: str, fuente: Fuente, valores: Mapping[str, Column], corrupto: bool) -> Column:
    """Whether a raw row, typed as `valores`, breaks a rule. Never NULL."""
    tipo, _, nombre = regla.partition(":")
    if tipo == "registro_corrupto":
        return F.col(CORRUPTO).isNotNull() if corrupto else F.lit(False)
    if tipo == MONTO_NO_POSITIVO:
        return F.coalesce(valores[fuente.monto] <= 0, F.lit(False))
    if tipo == CANTIDAD_NO_POSITIVA:
        return F.coalesce(valores[fuente.cantidad] <= 0, F.lit(False))
    if tipo == "vacio":
        return ~no_vacio(valores[nombre])
    crudo = F.col(fuente.columnas[nombre]) if nombre in fuente.columnas else valores[nombre]
    return crudo.isNull() if tipo == "nulo" else crudo.isNotNull() & valores[nombre].isNull()


def falta(fuente: Fuente, *motivos: str) -> Column:
    """Whether a typed row breaks any of the given rules."""
    bits = sum(1 << i for i, regla in enumerate(reglas(fuente)) if regla in motivos)
    return F.col("_faltas").bitwiseAND(bits) != 0


def motivos(fuente: Fuente) -> Column:
    """The broken rules by name."""
    return _presentes({m: falta(fuente, m) for m in reglas(fuente)})


def por_motivo(df: DataFrame, *columnas: str | Column) -> DataFrame:
    """One row per reason in `_motivos`, as `motivo` beside the given columns; rows without a reason have none.

    For an inner explode Spark first drops rows by the array's size, and Catalyst copies that filter down into the
    feed's joins with `_faltas`, all rules added up, in place of each rule's bit. An outer one brings no such filter.
    """
    return df.select(*columnas, F.explode_outer("_motivos").alias("motivo")).where("motivo IS NOT NULL")


def _presentes(banderas: Mapping[str, Column]) -> Column:
    """Names whose flag is set, as an array."""
    return F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in banderas.items()]))


def tipar(df: DataFrame, fuente: Fuente, *, conservar: Sequence[str] = ()) -> DataFrame:
    """One projection: rename, normalise, cast, scale money, move local times to UTC.

    Only what the feed carries is kept, which keeps the rows that go through the deduplication
    shuffle narrow: constants and hashes are added by `completar` afterwards. `_faltas` (one bit per
    broken rule, plain integer arithmetic) and `_netas` (stock before clamping) are pruned by Catalyst
    unless used. `conservar` names source columns to carry along as they are (an arrival time, say).
    """
    tipos = dict(df.dtypes)
    valores = {
        campo.name: _valor(fuente, campo, tipos)
        for campo in fuente.contrato
        if campo.name in fuente.columnas
    }
    extra = []
    if fuente.stock:
        netas = existencias_netas(*map(F.col, fuente.stock))
        valores["stock_disponible"] = existencias_disponibles(netas)
        extra.append(netas.alias("_netas"))
    if CORRUPTO in df.columns:
        extra.append(F.col(CORRUPTO).isNotNull().alias("_corrupto"))
    bits = [
        F.when(_incumple(regla, fuente, valores, CORRUPTO in df.columns), F.lit(1 << i)).otherwise(F.lit(0))
        for i, regla in enumerate(reglas(fuente))
    ]
    faltas = reduce(add, bits).cast("long")
    return df.select(*[v.alias(n) for n, v in valores.items()], *extra, faltas.alias("_faltas"), *conservar)


def _integra(tipado: DataFrame, fuente: Fuente) -> Column:
    """Readable, keys present, nothing missing that the contract demands. Never NULL."""
    partes = [no_vacio(F.col(c)) for c in fuente.requeridas]
    partes += [
        F.col(f.name).isNotNull()
        for f in fuente.contrato
        if f.name in tipado.columns and not f.nullable and f.name not in fuente.requeridas
    ]
    if "_corrupto" in tipado.columns:
        partes.append(~F.col("_corrupto"))
    return reduce(and_, partes)


def es_valida(tipado: DataFrame, fuente: Fuente) -> Column:
    """True exactly when no rule is broken, from the typed columns alone.

    Filters use this instead of `_faltas` or `_clase`: a short-circuit conjunction stays cheap when
    Catalyst substitutes it below projections and into joins.
    """
    positivas = [F.col(c) > 0 for c in (fuente.monto, fuente.cantidad) if c]
    return reduce(and_, positivas, _integra(tipado, fuente))


def es_devolucion(tipado: DataFrame, fuente: Fuente) -> Column:
    """An otherwise sound row with a negative amount, whatever its quantity."""
    if not fuente.monto:
        return F.lit(False)
    return (F.col(fuente.monto) < 0) & _integra(tipado, fuente)


def clase(tipado: DataFrame, fuente: Fuente) -> Column:
    """valida / devolucion / rechazo for a typed row; a zero or missing amount is a reject."""
    return (
        F.when(es_valida(tipado, fuente), F.lit(VALIDA))
        .when(es_devolucion(tipado, fuente), F.lit(DEVOLUCION))
        .otherwise(F.lit(RECHAZO))
    )


def validas(df: DataFrame, fuente: Fuente, *, conservar: Sequence[str] = ()) -> DataFrame:
    """Valid rows of a *raw* feed, typed."""
    tipado = tipar(df, fuente, conservar=conservar)
    return tipado.where(es_valida(tipado, fuente)).drop("_faltas", "_netas", "_corrupto")


def devueltas(df: DataFrame, fuente: Fuente, *, conservar: Sequence[str] = ()) -> DataFrame:
    """Returns of a raw feed, typed and classified."""
    tipado = tipar(df, fuente, conservar=conservar)
    return tipado.where(es_devolucion(tipado, fuente)).withColumn("_clase", F.lit(DEVOLUCION))


def rechazadas(df: DataFrame, fuente: Fuente, *, conservar: Sequence[str] = ()) -> DataFrame:
    """Rejects of a raw feed, typed and classified."""
    tipado = tipar(df, fuente, conservar=conservar)
    mala = ~es_valida(tipado, fuente) & ~es_devolucion(tipado, fuente)
    return tipado.where(mala).withColumn("_clase", F.lit(RECHAZO))


def clasificar(df: DataFrame, fuente: Fuente, *, conservar: Sequence[str] = ()) -> DataFrame:
    """All rows of a raw feed, typed, each with its class and broken rules."""
    tipado = tipar(df, fuente, conservar=conservar)
    return tipado.withColumn("_clase", clase(tipado, fuente))


def completar(
    df: DataFrame, fuente: Fuente, run_ts: datetime, *, sal: str | None = None, conservar: Sequence[str] = ()
) -> DataFrame:
    """Typed rows -> exact contract: hash personal data, add constants and audit columns.

    Columns outside the contract and `conservar` are dropped; a classified frame keeps `_clase` and its
    reasons.
    """
    fijas = {**fuente.constantes, "_fuente": fuente.etiqueta, "_procesado_en": run_ts}
    salida = []
    for campo in fuente.contrato:
        if campo.name in fijas:
            col = F.lit(fijas[campo.name])
        elif campo.name in fuente.pii:
            col = huella(F.col(campo.name), sal=sal)
        else:
            col = F.col(campo.name)
        salida.append(col.cast(campo.dataType).alias(campo.name))
    if "_clase" in df.columns:
        salida += [F.col("_clase"), motivos(fuente).alias("_motivos")]
    return df.select(*salida, *conservar)


def validar_no_vacios(df: DataFrame, columnas: list[str]) -> DataFrame:
    """Rows whose listed columns are all present and not blank."""
    return df.where(reduce(and_, [no_vacio(F.col(c)) for c in columnas], F.lit(True)))


def rechazar_vacios(df: DataFrame, columnas: list[str]) -> DataFrame:
    """Exact complement of `validar_no_vacios`, with the offending columns in `_motivos`."""
    vacias = {f"vacio:{c}": ~no_vacio(F.col(c)) for c in columnas}
    return df.where(reduce(or_, vacias.values(), F.lit(False))).withColumn("_motivos", _presentes(vacias))


def mask_pii(df: DataFrame, *columnas: str, sal: str | None = None, normalizar: bool = False) -> DataFrame:
    """Replace personal data (client ids, e-mails, names, addresses, cards) by SHA-256 digests."""
    return df.withColumns({c: huella(F.col(c), sal=sal, normalizar=normalizar) for c in columnas})
