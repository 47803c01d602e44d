"""The lake's own tables: partitioned writes that can be repeated, pruned reads, SQL names."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from datetime import date, timedelta
from functools import reduce
from itertools import product
from operator import and_

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

DIA = ("year", "month", "day")
# Digests in hex take half the space that the default codec leaves them.
CODEC = "zstd"


def _fecha(x: date | str) -> date:
    return date.fromisoformat(x) if isinstance(x, str) else x


def _ruta(raiz: str, tabla: str) -> str:
    return f"{raiz.rstrip('/')}/{tabla}"


def rutas_existentes(spark: SparkSession, *patrones: str) -> list[str]:
    """Paths that match the given globs, asked from the file system; only their parent folders are listed."""
    camino = spark._jvm.org.apache.hadoop.fs.Path
    halladas = []
    for patron in patrones:
        p = camino(patron)
        vistas = p.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(p)
        halladas += [e.getPath().toString() for e in vistas or []]
    return halladas


def borrar(spark: SparkSession, ruta: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(ruta)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def mover_particiones(spark: SparkSession, origen: str, ruta: str, partes: Mapping[str, bool]) -> None:
    """Put finished partition folders of `origen` in the place of those of the table at `ruta`, without reading rows.

    `partes` says of every folder whether it had rows when it was finished; one without only goes from the table.
    Can be repeated: a folder that had rows and is no longer in `origen` is in its place already.
    """
    camino = spark._jvm.org.apache.hadoop.fs.Path
    fs = camino(ruta).getFileSystem(spark._jsc.hadoopConfiguration())
    for parte, con_filas in partes.items():
        nueva, vieja = camino(f"{origen}/{parte}"), camino(f"{ruta}/{parte}")
        if fs.exists(nueva):
            fs.delete(vieja, True)
            fs.mkdirs(vieja.getParent())
            if not fs.rename(nueva, vieja):
                raise OSError(f"{origen}/{parte} could not be moved to {ruta}")
        elif not con_filas:
            fs.delete(vieja, True)
    spark.catalog.refreshByPath(ruta)


NOTA = "_nota.json"


def anotar(spark: SparkSession, carpeta: str, nota: Mapping[str, object]) -> None:
    """Leaves a small note in a folder, at once or not at all: it is renamed into its place."""
    camino = spark._jvm.org.apache.hadoop.fs.Path
    lista, a_medias = camino(f"{carpeta}/{NOTA}"), camino(f"{carpeta}/{NOTA}.tmp")
    fs = lista.getFileSystem(spark._jsc.hadoopConfiguration())
    salida = fs.create(a_medias, True)
    salida.write(bytearray(json.dumps(nota).encode()))
    salida.close()
    fs.delete(lista, False)
    fs.rename(a_medias, lista)


def leer_nota(spark: SparkSession, carpeta: str) -> dict:
    p = spark._jvm.org.apache.hadoop.fs.Path(f"{carpeta}/{NOTA}")
    entrada = p.getFileSystem(spark._jsc.hadoopConfiguration()).open(p)
    texto = spark._jvm.org.apache.commons.io.IOUtils.toString(entrada, "UTF-8")
    entrada.close()
    return json.loads(texto)


def _prefijo(spark: SparkSession, ruta: str) -> str | None:
    """Glob of the partition levels before `year=`; None if nothing has been written."""
    nivel = ""
    while hijos := rutas_existentes(spark, f"{ruta}/{nivel}*=*"):
        if any(h.rpartition("/")[2].startswith("year=") for h in hijos):
            return nivel
        nivel += "*/"
    return None


def _exigir_nivel(spark: SparkSession, ruta: str, hora: int | None) -> None:
    """A table is partitioned by hour or it is not: a mixture could not be read any more."""
    nivel = _prefijo(spark, ruta)
    if nivel is None:
        return
    dia = rutas_existentes(spark, f"{ruta}/{nivel}year=*")[-1]
    for parte in ("month", "day"):
        dia = max(rutas_existentes(spark, f"{dia}/{parte}=*"))
    por_hora = bool(rutas_existentes(spark, f"{dia}/hour=*"))
    if por_hora != (hora is not None):
        raise ValueError(f"{ruta} is partitioned {'by hour' if por_hora else 'by day'}; give `hora` accordingly")


def escribir_silver(
    df: DataFrame,
    tabla: str,
    raiz: str,
    run_date: date | str,
    *,
    hora: int | None = None,
    por: Mapping[str, Sequence[str]] | None = None,
    compactar: bool = False,
) -> int:
    """Replace the run date's partition (`year=/month=/day=[/hour=]`) and return the rows written.

    Other dates are untouched (dynamic overwrite), so a rerun is idempotent. Dynamic overwrite leaves
    a partition alone when the new run has no rows for it; such partitions are emptied explicitly.
    `por` names leading partition columns and the values this run is responsible for; parts with other
    values stay as they are. `compactar` rebalances rows into files of the advisory size first; AQE splits
    a hot partition, so no task holds a whole day.
    """
    spark, ruta = df.sparkSession, _ruta(raiz, tabla)
    _exigir_nivel(spark, ruta, hora)
    dia = _fecha(run_date)
    valores = {"year": dia.year, "month": dia.month, "day": dia.day}
    if hora is not None:
        valores["hour"] = hora
    por = por or {}
    partes = [dict(zip(por, v, strict=True)) for v in product(*por.values())]
    salida = df.hint("rebalance", *por) if compactar else df
    # On top of the plan, hence in the writing stage, where a retried task is counted once.
    medida = Observation(f"filas_{tabla}")
    cuentas = [
        F.count_if(reduce(and_, [F.col(c) == v for c, v in p.items()], F.lit(True))).alias(f"n{i}")
        for i, p in enumerate(partes)
    ]
    # The constants come last: Spark then sees that no sort by them is needed before the write.
    salida = salida.observe(medida, *cuentas).withColumns({c: F.lit(v) for c, v in valores.items()})
    (
        salida.write.mode("overwrite")
        .options(partitionOverwriteMode="dynamic", compression=CODEC)
        .partitionBy(*por, *valores)
        .parquet(ruta)
    )
    filas = medida.get
    for i, parte in enumerate(partes):
        if filas[f"n{i}"] == 0:
            vaciar(df.drop(*por), ruta, {**parte, **valores})
    return sum(filas.values())


def vaciar(df: DataFrame, ruta: str, particion: Mapping[str, object]) -> None:
    """Leave a partition without rows but readable."""
    sub = "/".join(f"{c}={v}" for c, v in particion.items())
    df.limit(0).write.mode("overwrite").parquet(f"{ruta}/{sub}")


def escribir_particiones(
    df: DataFrame, tabla: str, raiz: str, columnas: Sequence[str], esperadas: Sequence[Mapping[str, object]]
) -> int:
    """Replace, in one write, the partitions by `columnas` that `df` has; those `esperadas` without rows are emptied.

    Rows are rebalanced by partition, so files do not multiply by the number of tasks. Returns the rows written.
    """
    ruta, vistas = _ruta(raiz, tabla), Observation(f"particiones_{tabla}")
    partes = F.collect_set(F.concat_ws("/", *columnas)).alias("vistas")
    (
        df.hint("rebalance", *columnas)
        .observe(vistas, partes, F.count(F.lit(1)).alias("filas"))
        .write.mode("overwrite")
        .options(partitionOverwriteMode="dynamic", compression=CODEC)
        .partitionBy(*columnas)
        .parquet(ruta)
    )
    con_filas = set(vistas.get["vistas"])
    for particion in esperadas:
        if "/".join(str(particion[c]) for c in columnas) not in con_filas:
            vaciar(df.drop(*columnas), ruta, {c: particion[c] for c in columnas})
    return vistas.get["filas"]


def en_fechas(desde: date | str, hasta: date | str | None = None) -> Column:
    """Predicate on the written partition columns, so it prunes folders."""
    d = _fecha(desde)
    if hasta is None:
        return (F.col("year") == d.year) & (F.col("month") == d.month) & (F.col("day") == d.day)
    return F.make_date(*map(F.col, DIA)).between(F.lit(d), F.lit(_fecha(hasta)))


def leer_silver(
    spark: SparkSession,
    tabla: str,
    raiz: str,
    desde: date | str | None = None,
    hasta: date | str | None = None,
) -> DataFrame:
    """A Silver table, whole or for a run date / a closed range of run dates.

    For dates only their own folders are listed, however long the history is. The partition column `feed`,
    which tells whose part of the table a run replaces, is left out; `_fuente` says the same.
    """
    ruta = _ruta(raiz, tabla)
    lector = spark.read.option("basePath", ruta)
    if desde is None:
        return lector.parquet(ruta).drop("feed")
    dias = (_fecha(hasta) - _fecha(desde)).days if hasta is not None else 0
    pedidos = [_fecha(desde) + timedelta(days=i) for i in range(dias + 1)]
    return leer_dias(spark, tabla, raiz, pedidos).where(en_fechas(desde, hasta))


def leer_dias(spark: SparkSession, tabla: str, raiz: str, dias: Sequence[date]) -> DataFrame:
    """The named run dates of a Silver table; only their folders are listed."""
    ruta = _ruta(raiz, tabla)
    lector = spark.read.option("basePath", ruta)
    nivel = _prefijo(spark, ruta)
    if nivel is None:
        return lector.parquet(ruta)  # says that there is no such table
    carpetas = rutas_existentes(spark, *[f"{ruta}/{nivel}year={d.year}/month={d.month}/day={d.day}" for d in dias])
    if not carpetas:
        una = rutas_existentes(spark, f"{ruta}/{nivel}year=*/month=*/day=*")[:1]
        return lector.parquet(*una).where(F.lit(False)).drop("feed")
    return lector.parquet(*carpetas).drop("feed")


def escribir_por_fecha(df: DataFrame, tabla: str, raiz: str, columna: str) -> None:
    """Backfill: replace every date present in `columna` in one write, about one file per date.

    Rows are rebalanced by date, so files do not multiply by the number of tasks, and a date too big
    for one file is split by AQE.
    """
    dia = {"year": F.year(columna), "month": F.month(columna), "day": F.dayofmonth(columna)}
    (
        df.withColumns(dia)
        .hint("rebalance", *DIA)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*DIA)
        .parquet(_ruta(raiz, tabla))
    )


def publicar_vista(df: DataFrame, nombre: str) -> None:
    """Make a frame readable from `spark.sql` in this session."""
    df.createOrReplaceTempView(nombre)


def publicar_tabla(spark: SparkSession, nombre: str, raiz: str, tabla: str) -> None:
    """Register a written, partitioned table in the session catalog as `database.table`."""
    base, punto, _ = nombre.partition(".")
    if punto and not spark.catalog.databaseExists(base):
        spark.sql(f"CREATE DATABASE {base} LOCATION :ruta", args={"ruta": _ruta(raiz, "")})
    if not spark.catalog.tableExists(nombre):
        spark.catalog.createTable(nombre, path=_ruta(raiz, tabla), source="parquet")
    spark.catalog.recoverPartitions(nombre)
