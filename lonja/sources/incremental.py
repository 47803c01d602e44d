"""Incremental extraction by high-water mark, from a table or over JDBC."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lonja.contracts import Fuente
from lonja.sources.bronze import ruta_bronze


def extraer_incremental(
    df: DataFrame,
    columna: str,
    marca: datetime | None,
    *,
    hasta: datetime | None = None,
    solape: timedelta = timedelta(0),
) -> DataFrame:
    """Rows with `marca - solape < columna <= hasta`; everything when there is no mark yet.

    The comparison is on the bare column, so it reaches the source (Parquet row groups, JDBC WHERE).
    `hasta` closes the window so that rows arriving during the read belong to the next one. `solape`
    re-reads a little of the past for late commits; deduplication downstream removes the repeats.
    """
    if marca is not None:
        df = df.where(F.col(columna) > F.lit(marca - solape).cast(df.schema[columna].dataType))
    if hasta is not None:
        df = df.where(F.col(columna) <= F.lit(hasta).cast(df.schema[columna].dataType))
    return df


def nueva_marca(df: DataFrame, columna: str, marca: datetime | None = None) -> DataFrame:
    """One row: the mark to use next time. It never goes back, also when nothing new arrived."""
    tipo = df.schema[columna].dataType
    return df.agg(F.greatest(F.max(columna), F.lit(marca).cast(tipo)).alias("marca"))


def ingerir(
    df: DataFrame,
    fuente: Fuente,
    bronze: str,
    run_date: date | str,
    columna: str,
    marca: datetime | None,
    hasta: datetime,
    *,
    solape: timedelta = timedelta(0),
    origen: str = "extracto",
) -> datetime | None:
    """Land the window (marca - solape, hasta] of a source table in Bronze and return the next mark.

    Without a mark this is the first load: everything up to `hasta`. `solape` re-reads a little of the past,
    so that rows committed late below the mark are not lost; the repeats are removed by the deduplication
    of Silver and Gold. The window has its own `lote=` folder under its origin, so repeating an extract
    replaces it and nothing else. The mark is observed while the rows are written and never goes back.
    """
    vista = Observation("marca")
    nuevas = extraer_incremental(df, columna, marca, hasta=hasta, solape=solape)
    lote = marca.strftime("%Y%m%dT%H%M%S%f") if marca else "inicio"
    (
        nuevas.observe(vista, F.max(F.col(columna).cast("timestamp_ntz").cast("string")).alias("marca"))
        .write.mode("overwrite")
        .parquet(ruta_bronze(bronze, fuente.tabla, run_date, origen=origen, lote=lote))
    )
    ultima = vista.get["marca"]
    return max(filter(None, [marca, datetime.fromisoformat(ultima) if ultima else None]), default=None)


def opciones_jdbc(
    url: str,
    tabla: str,
    columna: str,
    marca: datetime | None,
    hasta: datetime,
    *,
    inicio: datetime = datetime(2000, 1, 1),
    particiones: int = 8,
    filas_por_viaje: int = 10_000,
    **propiedades: str,
) -> dict[str, str]:
    """Reader options that split the window (marca, hasta] evenly over parallel connections.

    The bounds only decide how the rows are split, none is left out by them. A first load has no mark and is
    split from `inicio` on.
    """
    desde = marca or inicio
    if particiones < 1 or hasta <= desde:
        raise ValueError("needs at least one partition and a window that ends after the mark")
    return {
        "url": url,
        "dbtable": tabla,
        "partitionColumn": columna,
        "lowerBound": desde.strftime("%Y-%m-%d %H:%M:%S"),
        "upperBound": (hasta + timedelta(seconds=1)).strftime("%Y-%m-%d %H:%M:%S"),
        "numPartitions": str(particiones),
        "fetchsize": str(filas_por_viaje),
        "pushDownPredicate": "true",
        **propiedades,
    }


def leer_jdbc_incremental(
    spark: SparkSession,
    url: str,
    tabla: str,
    columna: str,
    marca: datetime | None,
    hasta: datetime,
    *,
    solape: timedelta = timedelta(0),
    **opciones,
) -> DataFrame:
    """The window (marca - solape, hasta] of a database table, without scanning the rest of it."""
    df = spark.read.format("jdbc").options(**opciones_jdbc(url, tabla, columna, marca, hasta, **opciones)).load()
    return extraer_incremental(df, columna, marca, hasta=hasta, solape=solape)
