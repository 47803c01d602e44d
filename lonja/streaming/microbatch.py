"""Micro-batches that recompute whole run dates: latest version wins, nothing is ever late."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from lonja.contracts import CORRUPTO, Fuente
from lonja.plans.gold import procesar_gold
from lonja.plans.silver import exigir_utc, reprocesar
from lonja.sources.bronze import abrir_json, esquema_texto
from lonja.sources.lake import borrar, rutas_existentes
from lonja.streaming.origen import identidad


def leer_eventos(
    spark: SparkSession,
    fuente: Fuente,
    carpeta: str,
    *,
    formato: str = "json",
    esquema: StructType | None = None,
    archivos_por_lote: int | None = None,
) -> DataFrame:
    """Stream of the files a receiver lands in a folder, each with its arrival time `_llegada`.

    Text formats are read as text columns; the corrupt-record column tells broken lines apart.
    """
    if esquema is None:
        esquema = fuente.bronze if formato == "parquet" else esquema_texto(fuente)
    lector = spark.readStream.format(formato).schema(esquema)
    if formato != "parquet":
        lector = lector.option("columnNameOfCorruptRecord", CORRUPTO)
    if formato == "csv":
        lector = lector.option("header", True)
    if archivos_por_lote:
        lector = lector.option("maxFilesPerTrigger", archivos_por_lote)
    return lector.load(carpeta).select("*", F.col("_metadata.file_modification_time").alias("_llegada"))


def leer_eventos_abiertos(
    spark: SparkSession, fuente: Fuente, carpeta: str, *, archivos_por_lote: int | None = None
) -> DataFrame:
    """Stream of JSON event files whose events may carry more fields than the feed describes (`abrir_json`)."""
    lector = spark.readStream.format("text")
    if archivos_por_lote:
        lector = lector.option("maxFilesPerTrigger", archivos_por_lote)
    lineas = lector.load(carpeta).where(F.trim("value") != "")
    return abrir_json(lineas.select("value", F.col("_metadata.file_modification_time").alias("_llegada")), fuente)


def iniciar_microlotes(
    flujo: DataFrame,
    fuente: Fuente,
    *,
    bronze: str,
    checkpoint: str,
    nombre: str = "eventos",
    fecha: Column | None = None,
) -> StreamingQuery:
    """Land every micro-batch in Bronze, under `fecha=/origen=/lote=`.

    Each event belongs to the run date `fecha`, by default the date its file arrived: a property of
    the data, so a batch replayed after a failure, even past midnight, lands in the same place. An event
    without that date takes its arrival date; without either the batch fails instead of losing it. A replay
    overwrites its own `lote=` folder only. The dates a batch brought are noted next to the checkpoint
    until `reconstruir` has worked on them. The trigger takes what is available and ends.
    """
    spark = flujo.sparkSession
    exigir_utc(spark)
    origen = identidad(spark, checkpoint, nombre)
    llegada = F.to_date("_llegada") if "_llegada" in flujo.columns else F.lit(None).cast("date")
    sin_fecha = F.raise_error(F.lit(f"{fuente.tabla}: an event has neither a run date nor an arrival date"))
    dia = F.coalesce(*([fecha.cast("date")] if fecha is not None else []), llegada, sin_fecha.cast("date"))
    columnas = [c for c in flujo.columns if c != "_llegada"]
    con_fecha = flujo.select(*columnas, dia.alias("fecha"))

    def lote(df: DataFrame, numero: int) -> None:
        sesion = df.sparkSession
        vistas = Observation("fechas_del_lote")  # the run dates come out of the write itself
        (
            df.withColumns({"origen": F.lit(origen), "lote": F.lit(numero)})
            .observe(vistas, F.collect_set("fecha").alias("fechas"))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("fecha", "origen", "lote")
            .parquet(f"{bronze.rstrip('/')}/{fuente.tabla}")
        )
        dias = sesion.createDataFrame([(d,) for d in vistas.get["fechas"]], "fecha date")
        dias.coalesce(1).write.mode("overwrite").parquet(f"{checkpoint.rstrip('/')}/lonja/lote={numero}")

    return (
        con_fecha.writeStream.foreachBatch(lote)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def reconstruir(
    spark: SparkSession,
    fuente: Fuente,
    *,
    bronze: str,
    silver: str,
    checkpoint: str,
    gold: str | None = None,
    run_ts: datetime | None = None,
) -> list[date]:
    """Rebuild, in one job, the run dates that landed batches touched and that were not rebuilt yet.

    Silver is a function of the dates' whole Bronze, so redelivered and restarted batches change nothing and
    a late event is just a row of its run date. Only the feed's own part of the tables is replaced. A failure
    leaves the notes in place, and the next call does the work again.
    """
    notas = rutas_existentes(spark, f"{checkpoint.rstrip('/')}/lonja/lote=*")
    if not notas:
        return []
    dias = sorted(f for (f,) in spark.read.schema("fecha date").parquet(*notas).distinct().collect())
    if dias:
        reprocesar(spark, bronze, silver, dias, run_ts=run_ts, fuentes=(fuente,))
        if gold and fuente.destino == "ventas":
            procesar_gold(spark, silver, gold, dias)
    for nota in notas:
        borrar(spark, nota)
    return dias


def ejecutar_microlotes(
    flujo: DataFrame,
    fuente: Fuente,
    *,
    bronze: str,
    silver: str,
    checkpoint: str,
    gold: str | None = None,
    nombre: str = "eventos",
    fecha: Column | None = None,
    run_ts: datetime | None = None,
) -> StreamingQuery:
    """Land what is available, in as many micro-batches as it takes, then rebuild the touched dates once.

    Any scheduler can launch this every 15 minutes; no state is kept but the notes of unfinished work.
    """
    consulta = iniciar_microlotes(flujo, fuente, bronze=bronze, checkpoint=checkpoint, nombre=nombre, fecha=fecha)
    consulta.awaitTermination()
    reconstruir(
        flujo.sparkSession, fuente, bronze=bronze, silver=silver, checkpoint=checkpoint, gold=gold, run_ts=run_ts
    )
    return consulta
