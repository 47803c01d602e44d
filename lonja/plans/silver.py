"""Bronze -> Silver: the per-feed pipelines, the unified sales and the whole job."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Mapping
from contextlib import contextmanager
from datetime import date, datetime, timezone
from functools import reduce
from itertools import product

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lonja.contracts import (
    INVENTARIO_ERP,
    VENTAS_ECOMMERCE,
    VENTAS_TIENDAS,
    Fuente,
)
from lonja.operators.conform import (
    DEVOLUCION,
    RECHAZO,
    VALIDA,
    clasificar,
    completar,
    devueltas,
    rechazadas,
    validas,
)
from lonja.operators.dedup import deduplicar
from lonja.operators.quality import calidad_fuente, filas_calidad, metricas_crudas
from lonja.sources.bronze import leer_bronze
from lonja.sources.lake import DIA, escribir_particiones, escribir_silver, leer_dias


def exigir_utc(spark: SparkSession) -> None:
    """Casts between text, local time and instants follow the session zone; Silver is UTC."""
    zona = spark.conf.get("spark.sql.session.timeZone")
    if zona not in ("UTC", "Etc/UTC", "Z", "GMT"):
        raise ValueError(f"spark.sql.session.timeZone is {zona!r}; set it to 'UTC'")


def transformar(
    df: DataFrame,
    fuente: Fuente,
    run_ts: datetime,
    *,
    llave: tuple[str, ...] | None = None,
    sal: str | None = None,
    por: tuple[str, ...] = (),
) -> DataFrame:
    """Raw feed -> its Silver contract: type, keep valid rows, keep the latest per key, complete.

    Hashes and constants are added after the deduplication, so they do not travel through its shuffle.
    `por` names columns that are kept and within whose values rows are unique (the run date, say).
    """
    unicas = deduplicar(validas(df, fuente, conservar=por), (*por, *(llave or fuente.llave)), fuente.orden)
    return completar(unicas, fuente, run_ts, sal=sal, conservar=por)


def transformar_ventas_tiendas(df: DataFrame, run_ts: datetime) -> DataFrame:
    return transformar(df, VENTAS_TIENDAS, run_ts)


def transformar_ventas_ecommerce(df: DataFrame, run_ts: datetime) -> DataFrame:
    return transformar(df, VENTAS_ECOMMERCE, run_ts)


def transformar_inventario(df: DataFrame, run_ts: datetime, *, por: tuple[str, ...] = ("tienda_id", "sku")) -> DataFrame:
    """Latest stock per store and sku; `por=("sku",)` keeps a single store's row per sku."""
    return transformar(df, INVENTARIO_ERP, run_ts, llave=por)


def unificar(*ventas: DataFrame) -> DataFrame:
    """Sales of all channels under one contract; duplicates across channels are kept."""
    return reduce(DataFrame.unionByName, ventas)


def devoluciones(df: DataFrame, fuente: Fuente, run_ts: datetime) -> DataFrame:
    """Returns, once per key like sales; `transformar` leaves them out."""
    vueltas = deduplicar(devueltas(df, fuente), fuente.llave, fuente.orden)
    return completar(vueltas, fuente, run_ts).drop("_clase", "_motivos")


def rechazos(df: DataFrame, fuente: Fuente, run_ts: datetime) -> DataFrame:
    """Rows that break a rule, with all their reasons in `_motivos`."""
    return completar(rechazadas(df, fuente), fuente, run_ts).drop("_clase")


TODAS = (VENTAS_TIENDAS, VENTAS_ECOMMERCE, INVENTARIO_ERP)


def _clases(fuentes: Iterable[Fuente]) -> tuple[str, ...]:
    return (DEVOLUCION, RECHAZO) if any(f.monto for f in fuentes) else (RECHAZO,)


def _de(df: DataFrame, fuente: Fuente) -> DataFrame:
    """Says whose part of the table the rows are."""
    return df.withColumn("feed", F.lit(fuente.tabla))


def _clase(todas: DataFrame, clase: str) -> DataFrame:
    return todas.where(F.col("_clase") == clase)


def _unicas(todas: DataFrame, clase: str, fuente: Fuente, *, por: tuple[str, ...] = ()) -> DataFrame:
    """The latest row per key among those of a class; without the columns that only rejects need, if they are valid."""
    filas = _clase(todas, clase).drop("_netas", "_corrupto", *(("_clase", "_faltas") if clase == VALIDA else ()))
    return deduplicar(filas, (*por, *fuente.llave), fuente.orden)


@contextmanager
def _clasificadas(
    crudas: Mapping[str, DataFrame], fuentes: Iterable[Fuente], *, conservar: tuple[str, ...] = ()
) -> Iterator[dict[str, DataFrame]]:
    """Every feed's rows, typed and classified once, for all outputs of a run.

    They are kept on the executors (in memory, what doesn't fit on disk), as shuffle files are, and not in the
    lake, since personal data is hashed in everything that is written. What a lost executor held is read again.
    """
    todas = {f.tabla: clasificar(crudas[f.tabla], f, conservar=conservar) for f in fuentes}
    try:
        yield {t: df.persist(StorageLevel.MEMORY_AND_DISK) for t, df in todas.items()}
    finally:
        for df in todas.values():
            df.unpersist()


def procesar_silver(
    spark: SparkSession,
    bronze: str,
    silver: str,
    run_date: date | str,
    *,
    run_ts: datetime | None = None,
    fuentes: tuple[Fuente, ...] = TODAS,
    formatos: Mapping[str, str] | None = None,
    permitir_vacio: bool = False,
    hora: int | None = None,
    sal: str | None = None,
) -> dict[str, int]:
    """Run one date end to end and return the rows written per table. Repeating it changes nothing.

    Per Silver table there are two writes: the clean rows, and `<table>_apartadas` with the returns and
    rejects under `clase=`. Both are partitioned by `feed`, so a run of some feeds leaves the others'
    rows alone. With `hora` the run takes what arrived in that hour (`hora=` in Bronze) into the
    partition `hour=`. Each feed is read, typed and classified once for all of this. The raw metrics are
    observed while the rejects are written, in a stage without a shuffle, so they cost no extra scan and are
    exact when tasks are retried. They end up in the table
    `calidad`. All frames are planned before the first write, so a missing source or column stops the
    run before anything changes.
    """
    exigir_utc(spark)
    run_ts = run_ts or datetime.now(timezone.utc)
    formatos = formatos or {}
    crudas = {
        f.tabla: leer_bronze(
            spark,
            f,
            bronze,
            run_date,
            formato=formatos.get(f.tabla, "parquet"),
            permitir_vacio=permitir_vacio,
            hora=hora,
        )
        for f in fuentes
    }
    medidas: dict[str, list[Observation]] = {}
    filas = {}
    with _clasificadas(crudas, fuentes) as clasificadas:
        planes: dict[str, tuple[DataFrame, DataFrame]] = {}
        for destino in dict.fromkeys(f.destino for f in fuentes):
            buenas, malas = [], []
            for f in (f for f in fuentes if f.destino == destino):
                todas = clasificadas[f.tabla]
                crudo, limpio, devuelto = (Observation(f"{n}_{f.tabla}") for n in ("crudo", "limpio", "devuelto"))
                medidas[f.tabla] = [crudo, limpio, devuelto] if f.monto else [crudo, limpio]
                unicas = completar(_unicas(todas, VALIDA, f), f, run_ts, sal=sal)
                buenas.append(_de(unicas.observe(limpio, F.count(F.lit(1)).alias("unicas")), f))
                vistas = todas.observe(crudo, *[c.alias(n) for n, c in metricas_crudas(f).items()])
                malas.append(_de(completar(_clase(vistas, RECHAZO), f, run_ts, sal=sal), f))
                if f.monto:
                    vueltas = _unicas(todas, DEVOLUCION, f).observe(devuelto, F.count(F.lit(1)).alias("devueltas"))
                    malas.append(_de(completar(vueltas, f, run_ts, sal=sal), f))
            apartada = unificar(*malas).withColumnsRenamed({"_clase": "clase", "_motivos": "motivos"})
            planes[destino] = (unificar(*buenas), apartada)
        for destino, (buena, mala) in planes.items():
            propias = [f for f in fuentes if f.destino == destino]
            feeds = [f.tabla for f in propias]
            aparte, clases = f"{destino}_apartadas", {"clase": _clases(propias), "feed": feeds}
            filas[destino] = escribir_silver(buena, destino, silver, run_date, hora=hora, por={"feed": feeds})
            filas[aparte] = escribir_silver(mala, aparte, silver, run_date, hora=hora, por=clases)
            for tabla in feeds:  # the next table's feeds need the room
                clasificadas[tabla].unpersist()
    sin_devueltas = {"devueltas": 0}
    observado = [
        {"tabla": t, **sin_devueltas, **{k: v for o in medidas[t] for k, v in o.get.items()}} for t in crudas
    ]
    informe = filas_calidad(spark.createDataFrame(observado).coalesce(1))
    informe = informe.withColumns({"_procesado_en": F.lit(run_ts).cast("timestamp"), "feed": F.col("tabla")})
    filas["calidad"] = escribir_silver(informe, "calidad", silver, run_date, hora=hora, por={"feed": list(crudas)})
    return filas


def reprocesar(
    spark: SparkSession,
    bronze: str,
    silver: str,
    fechas: Iterable[date | str],
    *,
    run_ts: datetime | None = None,
    fuentes: tuple[Fuente, ...] = TODAS,
    formatos: Mapping[str, str] | None = None,
    permitir_vacio: bool = False,
    sal: str | None = None,
) -> dict[str, dict[str, int]]:
    """Run past dates again from the untouched Bronze, all in one job; rows written per date and table.

    Each table is one write over all dates, with about one file per date and part: rows are unique per run
    date and key, and the metrics are grouped by run date. The result is that of `procesar_silver` date by date.
    """
    exigir_utc(spark)
    run_ts, formatos = run_ts or datetime.now(timezone.utc), formatos or {}
    dias = sorted({date.fromisoformat(f) if isinstance(f, str) else f for f in fechas})
    if not dias:
        return {}
    por = ("fecha",)
    crudas = {
        f.tabla: leer_bronze(
            spark, f, bronze, dias, formato=formatos.get(f.tabla, "parquet"), permitir_vacio=permitir_vacio
        )
        for f in fuentes
    }
    with _clasificadas(crudas, fuentes, conservar=por) as clasificadas:
        return _escribir_fechas(spark, silver, dias, fuentes, clasificadas, run_ts, sal, por)


def _escribir_fechas(
    spark: SparkSession,
    silver: str,
    dias: list[date],
    fuentes: tuple[Fuente, ...],
    clasificadas: Mapping[str, DataFrame],
    run_ts: datetime,
    sal: str | None,
    por: tuple[str, ...],
) -> dict[str, dict[str, int]]:
    tablas: dict[str, tuple[list[DataFrame], dict[str, list[str]]]] = {}
    for f in fuentes:
        todas = clasificadas[f.tabla]
        malas = [completar(_clase(todas, RECHAZO), f, run_ts, sal=sal, conservar=por)]
        if f.monto:
            malas.append(completar(_unicas(todas, DEVOLUCION, f, por=por), f, run_ts, sal=sal, conservar=por))
        malas = [m.withColumnsRenamed({"_clase": "clase", "_motivos": "motivos"}) for m in malas]
        informe = calidad_fuente(todas, f, por=por).withColumn("_procesado_en", F.lit(run_ts).cast("timestamp"))
        clases = {"clase": list(_clases([f]))}
        buena = completar(_unicas(todas, VALIDA, f, por=por), f, run_ts, sal=sal, conservar=por)
        for tabla, partes, antes in (
            (f.destino, [buena], {}),
            (f"{f.destino}_apartadas", malas, clases),
            ("calidad", [informe], {}),
        ):
            grupo, niveles = tablas.setdefault(tabla, ([], {**antes, "feed": []}))
            grupo += [_de(p, f) for p in partes]
            niveles["feed"].append(f.tabla)
            if antes and len(antes["clase"]) > len(niveles["clase"]):
                niveles["clase"] = antes["clase"]
    filas: dict[str, dict[str, int]] = {str(d): {} for d in dias}
    for tabla, (partes, niveles) in tablas.items():
        columnas = [*niveles, *DIA]
        esperadas = [
            {**dict(zip(niveles, v, strict=True)), "year": d.year, "month": d.month, "day": d.day}
            for d in dias
            for v in product(*niveles.values())
        ]
        fecha = {"year": F.year("fecha"), "month": F.month("fecha"), "day": F.dayofmonth("fecha")}
        escribir_particiones(unificar(*partes).withColumns(fecha).drop("fecha"), tabla, silver, columnas, esperadas)
        escritas = leer_dias(spark, tabla, silver, dias).groupBy(*DIA).count().collect()
        cuentas = {date(y, m, d): n for y, m, d, n in escritas}
        for d in dias:
            filas[str(d)][tabla] = cuentas.get(d, 0)
    return filas
