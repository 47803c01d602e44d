"""Index of sale keys: which run date delivered a sale, and for which sale date.

`<gold>/indice_ventas/mes=/tramo=/cubo=` holds one row per sale and run date. `mes` is the month of the run date,
`cubo` a hash bucket of the key. In the newest month every run date is a `tramo` of its own, which a rerun replaces
without reading it; as soon as a later month begins, a month is merged into the one part `tramo=mes`. So the number
of files follows the months and the buckets, not the run dates, and a few keys are looked up in their buckets only.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lonja.sources.lake import CODEC, mover_particiones, rutas_existentes

CLAVE = ("canal", "venta_id")
CUBOS = 16
ESQUEMA = "canal string, venta_id string, fecha date, _corrida date, mes string, tramo string, cubo int"
JUNTO = "mes"


def ruta_indice(gold: str) -> str:
    return f"{gold.rstrip('/')}/indice_ventas"


def con_cubo(llaves: DataFrame, cubos: int = CUBOS) -> DataFrame:
    return llaves.withColumn("cubo", F.pmod(F.xxhash64(*CLAVE), F.lit(cubos)).cast("int"))


def entradas(ventas: DataFrame) -> DataFrame:
    """Index rows of sales with `fecha` and `_corrida`: the latest sale date per key and run date."""
    return con_cubo(ventas.groupBy(*CLAVE, "_corrida").agg(F.max("fecha").alias("fecha")))


def _leer(spark: SparkSession, gold: str, carpetas: Sequence[str]) -> DataFrame | None:
    if not carpetas:
        return None
    return spark.read.schema(ESQUEMA).option("basePath", ruta_indice(gold)).parquet(*carpetas)


def tramos(spark: SparkSession, gold: str) -> dict[str, set[str]]:
    """The parts of every month."""
    halladas: dict[str, set[str]] = {}
    for ruta in rutas_existentes(spark, f"{ruta_indice(gold)}/mes=*/tramo=*"):
        mes, tramo = (p.rpartition("=")[2] for p in ruta.split("/")[-2:])
        halladas.setdefault(mes, set()).add(tramo)
    return halladas


def buscar_corridas(spark: SparkSession, gold: str, dias: Iterable[date]) -> DataFrame | None:
    """What the index says the given run dates delivered; None if it has no part that could say so."""
    dias, ruta = sorted(set(dias)), ruta_indice(gold)
    patrones = [f"{ruta}/mes={d:%Y-%m}/tramo={t}/cubo=*" for d in dias for t in (str(d), JUNTO)]
    carpetas = rutas_existentes(spark, *dict.fromkeys(patrones))
    leidas = _leer(spark, gold, carpetas)
    return leidas if leidas is None else leidas.where(F.col("_corrida").isin(dias))


def buscar_llaves(spark: SparkSession, gold: str, llaves: DataFrame, cubos: Iterable[int]) -> DataFrame | None:
    """All index rows of the given keys, which lie in the buckets `cubos`; only those folders are listed and read."""
    carpetas = rutas_existentes(spark, *[f"{ruta_indice(gold)}/mes=*/tramo=*/cubo={c}" for c in sorted(cubos)])
    leidas = _leer(spark, gold, carpetas)
    return leidas if leidas is None else leidas.join(llaves.select(*CLAVE), [*CLAVE], "left_semi")


def preparar(spark: SparkSession, gold: str, nuevas: DataFrame, dias: Iterable[date], destino: str) -> dict[str, bool]:
    """Writes what the index has to hold after the given run dates have delivered `nuevas` to the folder `destino`.

    Returns the parts, as `mes=[/tramo=]`, that this content replaces, and whether it has rows of them. Besides the
    run dates' own parts these are months that a later one has closed. Nothing of the index itself is changed.
    """
    dias, hay = sorted(set(dias)), tramos(spark, gold)
    ultimo = max([f"{d:%Y-%m}" for d in dias] + list(hay))
    propios = {f"{d:%Y-%m}" for d in dias}
    juntos = {m for m in propios | set(hay) if (m < ultimo and hay.get(m, set()) != {JUNTO}) or (m in propios and m < ultimo)}
    juntos |= {m for m in propios if JUNTO in hay.get(m, ())}
    partes = [f"mes={m}" for m in sorted(juntos)]
    partes += [f"mes={d:%Y-%m}/tramo={d}" for d in dias if f"{d:%Y-%m}" not in juntos]
    mes = F.date_format("_corrida", "yyyy-MM")
    carpetas = rutas_existentes(spark, *[f"{ruta_indice(gold)}/mes={m}/tramo=*/cubo=*" for m in sorted(juntos)])
    columnas = [*CLAVE, "fecha", "_corrida", "cubo"]
    todas, quedan = nuevas.select(*columnas), _leer(spark, gold, carpetas)
    if quedan is not None:
        todas = todas.unionByName(quedan.where(~F.col("_corrida").isin(dias)).select(*columnas))
    todas = todas.withColumn("mes", mes)
    tramo = F.when(F.col("mes").isin(sorted(juntos)), F.lit(JUNTO)).otherwise(F.col("_corrida").cast("string"))
    (
        todas.withColumn("tramo", tramo)
        .hint("rebalance", "mes", "tramo", "cubo")
        .sortWithinPartitions("mes", "tramo", "cubo", *CLAVE)
        .write.option("compression", CODEC)
        .partitionBy("mes", "tramo", "cubo")
        .parquet(destino)
    )
    return {p: bool(rutas_existentes(spark, f"{destino}/{p}")) for p in partes}


def reemplazar(spark: SparkSession, gold: str, partes: Mapping[str, bool], origen: str) -> None:
    """Puts prepared content in the place of `partes`. Can be repeated until it has gone through."""
    mover_particiones(spark, origen, ruta_indice(gold), partes)
