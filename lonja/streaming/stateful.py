"""Stateful forms: first-delivery deduplication within a horizon, running totals, late rows.

State is bounded by the horizon, and Spark's own operators drop events that are older. `escribir_primeras`
keeps them as a part of its output, `separar_tardias` tells rows apart that arrived late, and the micro-batch
recomputation (`lonja.streaming.microbatch`) has no horizon at all. Every checkpoint writes under an `origen=` of
its own, so that a new checkpoint over old events can't add to, or be mistaken for, what another one wrote.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from datetime import datetime

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from lonja.contracts import Fuente
from lonja.operators.conform import DEVOLUCION, VALIDA, clasificar, completar, validas
from lonja.plans.gold import MONTO, con_fecha
from lonja.sources.lake import borrar, rutas_existentes
from lonja.streaming.origen import identidad


def conformar_flujo(
    flujo: DataFrame, fuente: Fuente, run_ts: datetime, *, conservar: Sequence[str] = ()
) -> DataFrame:
    """Valid, typed and completed rows of a streaming feed, with the source columns `conservar`; stateless."""
    return completar(validas(flujo, fuente, conservar=conservar), fuente, run_ts, conservar=conservar)


def movimientos(flujo: DataFrame, fuente: Fuente, run_ts: datetime) -> DataFrame:
    """Sales and returns of a streaming feed: what changes a total, in either direction; stateless."""
    clasificadas = clasificar(flujo, fuente)
    cuentan = clasificadas.where(F.col("_clase").isin(VALIDA, DEVOLUCION))
    return completar(cuentan, fuente, run_ts).drop("_clase", "_motivos")


def primera_entrega(
    ventas: DataFrame,
    horizonte: str,
    *,
    llave: str = "venta_id",
    tiempo: str = "vendido_en",
    reparto: tuple[str, ...] = (),
) -> DataFrame:
    """Each sale once under redelivery: the first arrival within `horizonte` wins.

    A key redelivered in bulk would meet in one state partition. `reparto` names columns in which the
    copies differ (arrival time, a salt from the row's position in its file); copies are then first
    reduced per key and spread value, on many partitions, and only one row per pair reaches the second
    step. The columns must not change when a batch is replayed.
    """
    vistas = ventas.withWatermark(tiempo, horizonte)
    if reparto:
        vistas = vistas.dropDuplicatesWithinWatermark([llave, *reparto])
    return vistas.dropDuplicatesWithinWatermark([llave])


def separar_tardias(
    flujo: DataFrame, horizonte: str, *, tiempo: str = "vendido_en", llegada: str = "_llegada"
) -> tuple[DataFrame, DataFrame]:
    """(on time, late): late rows reached the lake more than `horizonte` after they happened.

    Stateless, so both parts together are exactly the input.
    """
    tarde = F.coalesce(F.col(tiempo) < F.col(llegada) - F.expr(f"INTERVAL {horizonte}"), F.lit(False))
    return flujo.where(~tarde), flujo.where(tarde)


def totales_en_flujo(ventas: DataFrame) -> DataFrame:
    """Running sales total by channel and date; the state holds one row per group."""
    return con_fecha(ventas).groupBy("canal", "fecha").agg(F.sum("monto_total").cast(MONTO).alias("ventas_totales"))


def escribir_anexo(flujo: DataFrame, ruta: str, checkpoint: str) -> StreamingQuery:
    """Append a stream to Parquet exactly once, taking what is available."""
    return (
        flujo.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(ruta)
    )


def _salida(spark: SparkSession, ruta: str, checkpoint: str, nombre: str, reemplazar: bool) -> str:
    """The folder of this stream's own output, named by the identity kept in its checkpoint.

    Output of another checkpoint is refused, since both would count the same events, unless `reemplazar` says that
    this stream begins anew over all of them; readers then see the newest stream's output only.
    """
    origen = identidad(spark, checkpoint, nombre)
    otros = [o for o in _origenes(spark, ruta) if o != origen]
    if otros and not reemplazar:
        raise ValueError(f"{ruta} holds the output of another checkpoint ({otros[-1]}); give reemplazar=True to supersede it")
    return f"{ruta.rstrip('/')}/origen={origen}"


def _origenes(spark: SparkSession, ruta: str) -> list[str]:
    """Names of the streams that wrote here, oldest first: names begin with the time they were made up."""
    return sorted(o.rpartition("=")[2] for o in rutas_existentes(spark, f"{ruta.rstrip('/')}/origen=*"))


def escribir_totales(
    totales: DataFrame, ruta: str, checkpoint: str, *, junta_cada: int = 16, reemplazar: bool = False
) -> StreamingQuery:
    """Keep a table of totals by channel and date up to date, writing only the groups a micro-batch changed.

    Update mode gives each changed group with its new total. They are written by month (`periodo=`) under the
    batch's own `lote=`, which a replay replaces, and `leer_totales` takes the newest row per group. After every
    `junta_cada` batches the groups are merged into one batch folder, so the number of files is bounded; the
    folders before it go with the next merge, for readers that have begun.
    """
    salida = _salida(totales.sparkSession, ruta, checkpoint, "totales", reemplazar)

    def lote(df: DataFrame, numero: int) -> None:
        spark = df.sparkSession
        previos = [c for c in _lotes_escritos(spark, salida) if _numero_de(c) < numero]
        cambios = df.select(*TOTALES).withColumn("periodo", F.date_format("fecha", "yyyy-MM"))
        juntar = numero % junta_cada == junta_cada - 1
        if juntar and previos:
            viejos = _ultimos(spark, salida, previos)
            cambios = viejos.join(df.select(*GRUPO), [*GRUPO], "left_anti").unionByName(cambios)
            cambios = cambios.hint("rebalance", "periodo")
        cambios.write.mode("overwrite").partitionBy("periodo").parquet(f"{salida}/lote={numero}")
        if juntar:
            for carpeta in previos:
                if _numero_de(carpeta) <= numero - junta_cada:
                    borrar(spark, carpeta)

    return (
        totales.writeStream.foreachBatch(lote)
        .outputMode("update")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


GRUPO = ("canal", "fecha")
TOTALES = (*GRUPO, "ventas_totales")
ESQUEMA_TOTALES = f"canal string, fecha date, ventas_totales {MONTO}, periodo string, lote int"


def _numero_de(carpeta: str) -> int:
    return int(carpeta.rpartition("=")[2])


def _lotes_escritos(spark: SparkSession, salida: str) -> list[str]:
    """Folders of completely written batches, oldest first."""
    hechos = [h.rpartition("/")[0] for h in rutas_existentes(spark, f"{salida}/lote=*/_SUCCESS")]
    return sorted(hechos, key=_numero_de)


def _ultimos(spark: SparkSession, salida: str, lotes: Sequence[str], periodos: Sequence[str] | None = None) -> DataFrame:
    """The newest row per group among some batches, with `periodo`."""
    leidos = spark.read.schema(ESQUEMA_TOTALES).option("basePath", salida).parquet(*lotes)
    if periodos is not None:
        leidos = leidos.where(F.col("periodo").isin(list(periodos)))
    ultimo = F.max_by("ventas_totales", "lote").alias("ventas_totales")
    return leidos.groupBy(*GRUPO, "periodo").agg(ultimo).select(*TOTALES, "periodo")


def leer_totales(spark: SparkSession, ruta: str, periodos: Sequence[str] | None = None) -> DataFrame:
    """The totals as of the last finished micro-batch, of all months or of some, whose folders alone are read.

    Before the first batch there are no rows.
    """
    for origen in _origenes(spark, ruta)[::-1]:
        salida = f"{ruta.rstrip('/')}/origen={origen}"
        lotes = _lotes_escritos(spark, salida)
        if lotes:
            return _ultimos(spark, salida, lotes, periodos).drop("periodo")
    return spark.createDataFrame([], ESQUEMA_TOTALES).select(*TOTALES)


A_TIEMPO, REPETIDA, TARDIA = "a_tiempo", "repetidas", "tardias"
NUNCA_TARDE = "TIMESTAMP '2200-01-01 00:00:00'"
DECIDIDA = "fila string, parte string"
# Keys meet in as many groups, each with one state row and one call per batch. A checkpoint keeps the number for life.
CUBETAS = 1 << 12
VISTAS = "llaves array<string>, hasta array<long>"
EXACTO = {  # instants to the microsecond
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def _decidir(_: tuple, tramos: Iterator[pd.DataFrame], estado: GroupState) -> Iterator[pd.DataFrame]:
    """What becomes of the rows of the keys of one group; the state is until when each key must be remembered.

    A row older than the watermark is late. The first other one of its key is on time, the next ones repeat it. A
    key is forgotten when the watermark has passed its newest row, since from then on all its copies are late; the
    timer is set for the next key to be forgotten.
    """
    marca, vistas = estado.getCurrentWatermarkMs(), dict(zip(*estado.get, strict=True)) if estado.exists else {}
    if not estado.hasTimedOut:
        for filas in tramos:
            llaves = filas["llave"].to_numpy(object)
            tiempo = filas["ms"].to_numpy("float64")  # exact for milliseconds; without a time a row is on time
            tarde = tiempo < marca
            parte = np.where(tarde, TARDIA, REPETIDA).astype(object)
            momento = np.maximum(np.nan_to_num(tiempo, nan=0), marca).astype("int64").tolist()
            for i, (llave, ms, es_tarde) in enumerate(zip(llaves, momento, tarde.tolist(), strict=True)):
                hasta = vistas.get(llave)
                if hasta is None:
                    if es_tarde:
                        continue
                    parte[i] = A_TIEMPO
                vistas[llave] = ms if hasta is None else max(hasta, ms)
            yield pd.DataFrame({"fila": filas["fila"], "parte": parte})
    vistas = {llave: hasta for llave, hasta in vistas.items() if hasta + 1 >= marca}
    if vistas:
        estado.update((list(vistas), list(vistas.values())))
        estado.setTimeoutTimestamp(min(vistas.values()) + 1)
    elif estado.exists:
        estado.remove()


def decidir_entregas(
    ventas: DataFrame, horizonte: str, *, llave: str = "venta_id", tiempo: str = "vendido_en"
) -> DataFrame:
    """All rows of a stream with `parte`: on time (the first of its key), repeated, or late.

    The watermark is the newest time of the batches before, less `horizonte`. Keys are remembered in the state
    store until the watermark passes them, so the state holds what the horizon holds. Spark drops rows behind the
    watermark before a stateful operator whose input carries the event time; here the time that drives the
    watermark is left out of the input and a second one, which is never late, stands in for it, so that late rows
    reach the function too. Rows travel as JSON, which keeps their types exact. Keys are dealt into `CUBETAS` groups
    by their hash, so that a batch costs one Python call per group and not one per key. All copies of a key in a batch
    meet in one task, some thousand at a time; `primera_entrega(reparto=...)` spreads them, without a second output.
    """
    esquema = ventas.schema
    fila = F.to_json(F.struct(*ventas.columns), EXACTO).alias("fila")
    reloj = ventas.withColumn("_reloj", F.col(tiempo)).withWatermark("_reloj", horizonte)
    clave = F.col(llave).cast("string")
    entrada = reloj.select(
        F.pmod(F.xxhash64(clave), F.lit(CUBETAS)).alias("cubeta"),
        clave.alias("llave"),
        F.unix_millis(F.col(tiempo).cast("timestamp")).alias("ms"),
        fila,
        F.expr(NUNCA_TARDE).alias("_pasa"),
    ).withWatermark("_pasa", "0 seconds")
    decididas = entrada.groupBy("cubeta").applyInPandasWithState(
        _decidir, DECIDIDA, VISTAS, "append", GroupStateTimeout.EventTimeTimeout
    )
    return decididas.select(F.from_json("fila", esquema, EXACTO).alias("f"), "parte").select("f.*", "parte")


def escribir_primeras(
    ventas: DataFrame,
    ruta: str,
    checkpoint: str,
    horizonte: str,
    *,
    llave: str = "venta_id",
    tiempo: str = "vendido_en",
    reemplazar: bool = False,
) -> StreamingQuery:
    """Each sale once, first delivery, and no row lost: `parte=a_tiempo`, `repetidas` and `tardias` (`leer_primeras`).

    The parts together are exactly the input. See `decidir_entregas` for the state, which RocksDB keeps.
    """
    spark = ventas.sparkSession
    salida = _salida(spark, ruta, checkpoint, "primeras", reemplazar)
    decididas = decidir_entregas(ventas, horizonte, llave=llave, tiempo=tiempo)
    ajustes = {
        "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
        # One stateful operator, with the two event times described there; a query keeps the settings it began with.
        "spark.sql.streaming.statefulOperator.allowMultiple": "false",
    }
    antes = {k: spark.conf.get(k, None) for k in ajustes}
    try:
        for k, v in ajustes.items():
            spark.conf.set(k, v)
        return (
            decididas.writeStream.format("parquet")
            .outputMode("append")
            .partitionBy("parte")
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start(salida)
        )
    finally:
        for k, v in antes.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def leer_primeras(spark: SparkSession, ruta: str, parte: str | None = None) -> DataFrame:
    """What `escribir_primeras` has written, whole or one part of it, of the newest stream that has output."""
    con_datos = [
        o for o in _origenes(spark, ruta) if rutas_existentes(spark, f"{ruta.rstrip('/')}/origen={o}/_spark_metadata/*")
    ]
    if not con_datos:
        raise FileNotFoundError(f"{ruta} has no output yet")
    leidas = spark.read.parquet(f"{ruta.rstrip('/')}/origen={con_datos[-1]}")
    return leidas if parte is None else leidas.where(F.col("parte") == parte).drop("parte")
