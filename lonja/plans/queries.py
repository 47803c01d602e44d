"""The named queries: each takes a session and a folder of test tables and returns a frame.

Instants are returned as zone-less UTC timestamps, and the run instant is fixed, so that results can
be compared with other engines. Queries about writing, landing or streaming do so under the shared
work folder and return what can be read back.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime, timedelta

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType, TimestampType

from lonja import feeds
from lonja.contracts import (
    CONTEOS_FISICOS,
    INVENTARIO_ERP,
    VENTAS_ECOMMERCE,
    VENTAS_TIENDAS,
)
from lonja.operators import bosquejos, quality, temporal
from lonja.operators.conform import (
    clasificar,
    mask_pii,
    por_motivo,
    rechazar_vacios,
    validar_no_vacios,
    validas,
)
from lonja.operators.quality import calidad_fuente, duplicados, log_quality
from lonja.plans import gold, silver
from lonja.sources import bronze, incremental, lake
from lonja.streaming import microbatch, stateful
from lonja.workspace import espacio

RUN_DATE = date(2025, 4, 13)
RUN_TS = datetime(2025, 4, 13, 10, 0)
DIA = date(2024, 1, 15)  # the business date of the one-day report
MARCA = datetime(1998, 1, 1)  # the high-water mark of the incremental extract
HORIZONTE = "60 days"
SALES = 32  # state partitions over which the copies of one sale may spread

Consulta = Callable[[SparkSession, str], DataFrame]
CONSULTAS: dict[str, Consulta] = {}


def consulta(f: Consulta) -> Consulta:
    def en_utc(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return sin_zona(f(spark, sf_dir))

    CONSULTAS[f.__name__] = en_utc
    return f  # inside this module instants stay instants


def sin_zona(df: DataFrame) -> DataFrame:
    instantes = [c.name for c in df.schema if isinstance(c.dataType, TimestampType)]
    return df.withColumns({c: F.col(c).cast(TimestampNTZType()) for c in instantes})


def _motivos_texto(df: DataFrame) -> DataFrame:
    return df.withColumn("motivos", F.array_join(F.array_sort("_motivos"), ",")).drop("_motivos")


# --- Silver ----------------------------------------------------------------------------------------


@consulta
def silver_ventas_tiendas(spark, sf_dir):
    return silver.transformar_ventas_tiendas(feeds.ventas_tiendas(spark, sf_dir), RUN_TS)


@consulta
def silver_ventas_ecommerce(spark, sf_dir):
    return silver.transformar_ventas_ecommerce(feeds.ventas_ecommerce(spark, sf_dir), RUN_TS)


@consulta
def silver_ventas(spark, sf_dir):
    return silver.unificar(silver_ventas_tiendas(spark, sf_dir), silver_ventas_ecommerce(spark, sf_dir))


@consulta
def silver_inventario(spark, sf_dir):
    return silver.transformar_inventario(feeds.inventario(spark, sf_dir), RUN_TS)


@consulta
def silver_inventario_por_sku(spark, sf_dir):
    return silver.transformar_inventario(feeds.inventario(spark, sf_dir), RUN_TS, por=("sku",))


@consulta
def silver_conteos(spark, sf_dir):
    """A feed added with nothing but its description."""
    return silver.transformar(feeds.conteos(spark, sf_dir), CONTEOS_FISICOS, RUN_TS)


@consulta
def rechazos_ventas(spark, sf_dir):
    tiendas = silver.rechazos(feeds.ventas_tiendas(spark, sf_dir), VENTAS_TIENDAS, RUN_TS)
    linea = silver.rechazos(feeds.ventas_ecommerce(spark, sf_dir), VENTAS_ECOMMERCE, RUN_TS)
    return _motivos_texto(silver.unificar(tiendas, linea))


@consulta
def rechazos_inventario(spark, sf_dir):
    """The stock mapping blanks no key, so the checks run on the sales feed's store and product codes."""
    crudo = feeds.ventas_tiendas(spark, sf_dir).selectExpr(
        "id_transaccion AS inv_id",
        "codigo_tienda AS store_code",
        "nombre_tienda AS store_name",
        "codigo_producto AS product_code",
        "qty AS qty_on_hand",
        "0 AS qty_reserved",
        "fecha_hora_venta AS last_updated",
    )
    return _motivos_texto(silver.rechazos(crudo, INVENTARIO_ERP, RUN_TS))


@consulta
def devoluciones(spark, sf_dir):
    return silver.unificar(
        silver.devoluciones(feeds.ventas_tiendas(spark, sf_dir), VENTAS_TIENDAS, RUN_TS),
        silver.devoluciones(feeds.ventas_ecommerce(spark, sf_dir), VENTAS_ECOMMERCE, RUN_TS),
    )


@consulta
def registros_validos(spark, sf_dir):
    """Rows of the raw store feed whose keys are all present."""
    return validar_no_vacios(
        feeds.ventas_tiendas(spark, sf_dir), ["id_transaccion", "codigo_producto", "codigo_tienda"]
    )


@consulta
def registros_vacios(spark, sf_dir):
    """The complement, with the blank columns named."""
    return _motivos_texto(
        rechazar_vacios(feeds.ventas_tiendas(spark, sf_dir), ["id_transaccion", "codigo_producto", "codigo_tienda"])
    )


@consulta
def clientes_enmascarados(spark, sf_dir):
    return mask_pii(feeds.ventas_ecommerce(spark, sf_dir), "customer_email")


# --- quality ---------------------------------------------------------------------------------------


@consulta
def calidad(spark, sf_dir):
    """Raw and clean metrics of every feed, plus the size of the unified sales."""
    por_fuente = [
        calidad_fuente(clasificar(crudo(spark, sf_dir), f), f)
        for crudo, f in (
            (feeds.ventas_tiendas, VENTAS_TIENDAS),
            (feeds.ventas_ecommerce, VENTAS_ECOMMERCE),
            (feeds.inventario, INVENTARIO_ERP),
        )
    ]
    return silver.unificar(*por_fuente)


@consulta
def calidad_cruda(spark, sf_dir):
    """The basic report over raw feeds, by their own column names."""
    return silver.unificar(
        log_quality(
            feeds.ventas_tiendas(spark, sf_dir), "bronze_raw", "ventas_tiendas", sku="codigo_producto", monto="total"
        ),
        log_quality(
            feeds.ventas_ecommerce(spark, sf_dir),
            "bronze_raw",
            "ventas_ecommerce",
            sku="product_sku",
            monto="total_amount",
        ),
        log_quality(feeds.inventario(spark, sf_dir), "bronze_raw", "inventario", sku="product_code"),
    )


@consulta
def calidad_ventas_unificadas(spark, sf_dir):
    return log_quality(silver_ventas(spark, sf_dir), "silver_clean", "ventas")


@consulta
def duplicados_fuente(spark, sf_dir):
    """How often the store feed repeats a transaction id."""
    return duplicados(feeds.ventas_tiendas(spark, sf_dir), ["id_transaccion"])


@consulta
def frecuencia_motivos(spark, sf_dir):
    """How often each rule is broken in the store feed."""
    return quality.frecuencia_motivos(clasificar(feeds.ventas_tiendas(spark, sf_dir), VENTAS_TIENDAS), VENTAS_TIENDAS)


# --- landing, writing, reading back ----------------------------------------------------------------


def _aterrizar(df: DataFrame, raiz: str, fuente, fecha=RUN_DATE) -> None:
    df.write.mode("overwrite").parquet(bronze.ruta_bronze(raiz, fuente.tabla, fecha))


@consulta
def bronze_por_fecha(spark, sf_dir):
    """The store feed landed under one run date per sales year, scanned back by folder."""
    raiz = espacio(spark, "bronze")
    crudo = feeds.ventas_tiendas(spark, sf_dir).withColumn("fecha", F.trunc("fecha_hora_venta", "year"))
    crudo.hint("rebalance", "fecha").write.partitionBy("fecha").parquet(f"{raiz}/{VENTAS_TIENDAS.tabla}")
    carpetas = lake.rutas_existentes(spark, f"{raiz}/{VENTAS_TIENDAS.tabla}/fecha=*")
    fechas = [c.rpartition("=")[2] for c in carpetas]
    leido = bronze.leer_bronze(spark, VENTAS_TIENDAS, raiz, fechas)
    return leido.groupBy("fecha").agg(
        F.count(F.lit(1)).alias("filas"), F.sum(F.col("total").cast("decimal(18,2)")).cast("decimal(18,2)").alias("total")
    )


@consulta
def bronze_json_ventas(spark, sf_dir):
    """The online feed as JSON lines, with a truncated line per error event among them."""
    return silver.transformar_ventas_ecommerce(_json_ecommerce(spark, sf_dir), RUN_TS)


@consulta
def bronze_json_rechazos(spark, sf_dir):
    roto = F.array_contains("_motivos", "registro_corrupto")
    malas = silver.rechazos(_json_ecommerce(spark, sf_dir), VENTAS_ECOMMERCE, RUN_TS)
    return malas.groupBy(roto.alias("corrupto")).agg(F.count(F.lit(1)).alias("filas"))


def _json_ecommerce(spark, sf_dir):
    raiz = espacio(spark, "bronze-json")
    crudo = feeds.ventas_ecommerce(spark, sf_dir).withColumn("created_at", F.col("created_at").cast("string"))
    buenas = crudo.select(F.to_json(F.struct(*crudo.columns)).alias("value"))
    rotas = (
        spark.read.parquet(f"{sf_dir}/events.parquet")
        .where("event_type = 'error'")
        .select(F.concat(F.lit('{"order_id": "'), "event_id", F.lit('", "product')).alias("value"))
    )
    buenas.unionByName(rotas).write.text(bronze.ruta_bronze(raiz, VENTAS_ECOMMERCE.tabla, RUN_DATE))
    return bronze.leer_bronze(spark, VENTAS_ECOMMERCE, raiz, RUN_DATE, formato="json")


@consulta
def bronze_csv_ventas(spark, sf_dir):
    """The store feed through CSV."""
    raiz = espacio(spark, "bronze-csv")
    crudo = feeds.ventas_tiendas(spark, sf_dir)
    (
        crudo.withColumn("fecha_hora_venta", F.col("fecha_hora_venta").cast("string"))
        .write.options(header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
        .csv(bronze.ruta_bronze(raiz, VENTAS_TIENDAS.tabla, RUN_DATE))
    )
    leido = bronze.leer_bronze(spark, VENTAS_TIENDAS, raiz, RUN_DATE, formato="csv")
    return silver.transformar_ventas_tiendas(leido, RUN_TS)


@consulta
def ventas_por_dia_podadas(spark, sf_dir):
    """Two run dates written, the second one rewritten, then both read back by partition."""
    raiz = espacio(spark, "silver")
    tiendas, linea = silver_ventas_tiendas(spark, sf_dir), silver_ventas_ecommerce(spark, sf_dir)
    manana = RUN_DATE + timedelta(days=1)
    lake.escribir_silver(tiendas, "ventas", raiz, RUN_DATE)
    for _ in range(2):
        lake.escribir_silver(linea, "ventas", raiz, manana)
    return (
        lake.leer_silver(spark, "ventas", raiz, RUN_DATE, manana)
        .groupBy("year", "month", "day", "canal")
        .agg(F.count(F.lit(1)).alias("n_ventas"), F.sum("monto_total").cast(gold.MONTO).alias("ventas_totales"))
    )


@consulta
def silver_por_fecha_de_venta(spark, sf_dir):
    """Backfill of the online sales by sale date, read back for one date."""
    raiz = espacio(spark, "silver")
    lake.escribir_por_fecha(silver_ventas_ecommerce(spark, sf_dir), "ventas", raiz, "vendido_en")
    return lake.leer_silver(spark, "ventas", raiz, DIA)


def _lago(spark, sf_dir) -> tuple[str, str]:
    crudas, limpias = espacio(spark, "bronze"), espacio(spark, "silver")
    _aterrizar(feeds.ventas_tiendas(spark, sf_dir), crudas, VENTAS_TIENDAS)
    _aterrizar(feeds.ventas_ecommerce(spark, sf_dir), crudas, VENTAS_ECOMMERCE)
    _aterrizar(feeds.inventario(spark, sf_dir), crudas, INVENTARIO_ERP)
    silver.procesar_silver(spark, crudas, limpias, RUN_DATE, run_ts=RUN_TS)
    return crudas, limpias


@consulta
def trabajo_silver(spark, sf_dir):
    """The whole Silver job from landed Bronze; its tables counted as written."""
    _, limpias = _lago(spark, sf_dir)
    ventas = lake.leer_silver(spark, "ventas", limpias, RUN_DATE).groupBy("_fuente").count()
    stock = lake.leer_silver(spark, "inventario", limpias, RUN_DATE).groupBy("_fuente").count()
    fuera = lake.leer_silver(spark, "ventas_apartadas", limpias, RUN_DATE).groupBy("_fuente", "clase").count()
    partes = [
        ventas.select(F.lit("ventas").alias("tabla"), "_fuente", F.lit("valida").alias("clase"), "count"),
        stock.select(F.lit("inventario").alias("tabla"), "_fuente", F.lit("valida").alias("clase"), "count"),
        fuera.select(F.lit("ventas_apartadas").alias("tabla"), "_fuente", "clase", "count"),
    ]
    return silver.unificar(*partes).withColumnRenamed("count", "filas")


@consulta
def trabajo_silver_calidad(spark, sf_dir):
    """The metrics the job observed while writing."""
    _, limpias = _lago(spark, sf_dir)
    return lake.leer_silver(spark, "calidad", limpias, RUN_DATE).drop("_procesado_en", "year", "month", "day")


@consulta
def trabajo_gold(spark, sf_dir):
    """Consolidated sales through the written Silver and Gold tables."""
    _, limpias = _lago(spark, sf_dir)
    oro = espacio(spark, "gold")
    gold.procesar_gold(spark, limpias, oro, RUN_DATE, grano="mes")
    return gold.leer_consolidadas(spark, oro)


@consulta
def extraccion_incremental(spark, sf_dir):
    """Orders changed since the mark; the predicate reaches the Parquet scan."""
    pedidos = spark.read.parquet(f"{sf_dir}/orders.parquet")
    return incremental.extraer_incremental(pedidos, "o_orderdate", MARCA)


@consulta
def marca_siguiente(spark, sf_dir):
    pedidos = spark.read.parquet(f"{sf_dir}/orders.parquet")
    nuevos = incremental.extraer_incremental(pedidos, "o_orderdate", MARCA)
    return incremental.nueva_marca(nuevos, "o_orderdate", MARCA)


# --- streaming -------------------------------------------------------------------------------------


def _flujo_eventos(spark, sf_dir):
    """The events table as a stream, with a salt from each row's position in its file."""
    esquema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    # As a glob, since a stream takes a plain path for a folder and the table may be one file.
    eventos = spark.readStream.schema(esquema).parquet(f"{sf_dir}/{{events.parquet}}")
    return eventos.withColumn("_sal", F.pmod("_metadata.row_index", F.lit(SALES)))


def _eventos_repetidos(spark, sf_dir, *auxiliares):
    """The online feed as a stream in which every event is delivered twice."""
    eventos = _flujo_eventos(spark, sf_dir)
    return feeds.ventas_ecommerce_de(eventos, *auxiliares).unionByName(
        feeds.ventas_ecommerce_de(eventos, *auxiliares)
    )


def _primeras(spark, sf_dir):
    repetidos = _eventos_repetidos(spark, sf_dir, "_sal")
    ventas = stateful.conformar_flujo(repetidos, VENTAS_ECOMMERCE, RUN_TS, conservar=("_sal",))
    return stateful.primera_entrega(ventas, HORIZONTE, reparto=("_sal",)).drop("_sal")


@consulta
def stream_ventas_ecommerce(spark, sf_dir):
    """Micro-batches into Bronze, the run date rebuilt in Silver."""
    crudas, limpias, marcas = (espacio(spark, n) for n in ("bronze", "silver", "checkpoint"))
    microbatch.ejecutar_microlotes(
        _eventos_repetidos(spark, sf_dir),
        VENTAS_ECOMMERCE,
        bronze=crudas,
        silver=limpias,
        checkpoint=marcas,
        fecha=F.lit(RUN_DATE),
        run_ts=RUN_TS,
    )
    return lake.leer_silver(spark, "ventas", limpias, RUN_DATE).drop("year", "month", "day")


@consulta
def stream_primera_entrega(spark, sf_dir):
    """Each sale once, first delivery, within the watermark horizon."""
    salida, marcas = espacio(spark, "silver"), espacio(spark, "checkpoint")
    stateful.escribir_anexo(_primeras(spark, sf_dir), salida, marcas).awaitTermination()
    return spark.read.parquet(salida)


@consulta
def stream_ventas_totales(spark, sf_dir):
    """Running totals over the redelivered stream."""
    salida, marcas = espacio(spark, "gold"), espacio(spark, "checkpoint")
    totales = stateful.totales_en_flujo(_primeras(spark, sf_dir))
    stateful.escribir_totales(totales, salida, marcas).awaitTermination()
    return stateful.leer_totales(spark, salida)


@consulta
def stream_ventas_tardias(spark, sf_dir):
    """Sales that arrive, at the end of the month, more than 15 days after they happened."""
    salida, marcas = espacio(spark, "silver"), espacio(spark, "checkpoint")
    eventos = _flujo_eventos(spark, sf_dir).withColumn("_llegada", F.lit(datetime(2024, 1, 31)))
    ventas = stateful.conformar_flujo(
        feeds.ventas_ecommerce_de(eventos, "_llegada"), VENTAS_ECOMMERCE, RUN_TS, conservar=("_llegada",)
    )
    _, tarde = stateful.separar_tardias(ventas, "15 days")
    stateful.escribir_anexo(tarde.drop("_llegada"), salida, marcas).awaitTermination()
    return spark.read.parquet(salida)


# --- deliveries that repeat, come late or come in parts ---------------------------------------------


def _aterrizar_json(df: DataFrame, carpeta: str) -> None:
    """Event files as a receiver would leave them, times as text."""
    df = df.withColumn("created_at", F.col("created_at").cast("string"))
    df.select(F.to_json(F.struct(*df.columns)).alias("value")).write.text(carpeta)


def _flujo_json(spark, df, nombre):
    """The stream of event files that `leer_eventos` gives."""
    carpeta = espacio(spark, nombre)
    _aterrizar_json(df, carpeta)
    return microbatch.leer_eventos(spark, VENTAS_ECOMMERCE, carpeta)


def _numero(columna: str = "order_id"):
    return F.col(columna).cast("long")


@consulta
def gold_entregas_repetidas(spark, sf_dir):
    """Sales of one run date; a third delivered again the next day, half of these newer, a day later and of
    twice the amount; a fifth once more by a stream on the day after. Gold counts each once."""
    crudas, limpias, oro, marcas = (espacio(spark, n) for n in ("bronze", "silver", "gold", "checkpoint"))
    ventas = feeds.ventas_ecommerce(spark, sf_dir)
    otra_vez = ventas.where(_numero() % 3 == 0)
    cambia = _numero() % 6 == 0
    otra_vez = otra_vez.withColumns(
        {
            "created_at": F.when(cambia, F.col("created_at") + F.expr("INTERVAL 1 DAY")).otherwise(F.col("created_at")),
            "total_amount": F.when(cambia, F.col("total_amount") * 2).otherwise(F.col("total_amount")),
        }
    )
    for dias, entrega in enumerate((ventas, otra_vez)):
        fecha = RUN_DATE + timedelta(days=dias)
        _aterrizar(entrega, crudas, VENTAS_ECOMMERCE, fecha)
        silver.procesar_silver(spark, crudas, limpias, fecha, run_ts=RUN_TS, fuentes=(VENTAS_ECOMMERCE,))
        gold.procesar_gold(spark, limpias, oro, fecha)
    microbatch.ejecutar_microlotes(
        _flujo_json(spark, ventas.where(_numero() % 5 == 0), "eventos"),
        VENTAS_ECOMMERCE,
        bronze=crudas,
        silver=limpias,
        gold=oro,
        checkpoint=marcas,
        fecha=F.lit(RUN_DATE + timedelta(days=2)),
        run_ts=RUN_TS,
    )
    return gold.leer_consolidadas(spark, oro)


def _otra_version(ventas, dias: int, veces: int):
    """The same sales, moved by some days and of another amount."""
    return ventas.withColumns(
        {"created_at": F.col("created_at") + F.expr(f"INTERVAL {dias} DAY"), "total_amount": F.col("total_amount") * veces}
    )


def _entregar(spark, crudas, limpias, entrega, dias: int) -> date:
    fecha = RUN_DATE + timedelta(days=dias)
    _aterrizar(entrega, crudas, VENTAS_ECOMMERCE, fecha)
    silver.procesar_silver(spark, crudas, limpias, fecha, run_ts=RUN_TS, fuentes=(VENTAS_ECOMMERCE,))
    return fecha


@consulta
def gold_refresco_tardio(spark, sf_dir):
    """Three run dates, the middle one last: a third of the sales newer and of twice the amount, a quarter older,
    which must not count; then the first again without a seventh, whose other versions come up. As if built anew."""
    crudas, limpias, oro = (espacio(spark, n) for n in ("bronze", "silver", "gold"))
    ventas = feeds.ventas_ecommerce(spark, sf_dir)
    for entrega, dias in (
        (ventas, 0),
        (_otra_version(ventas.where(_numero() % 3 == 0), 1, 2), 2),
        (_otra_version(ventas.where(_numero() % 4 == 0), -1, 5), 1),
        (ventas.where(_numero() % 7 != 0), 0),
    ):
        gold.procesar_gold(spark, limpias, oro, _entregar(spark, crudas, limpias, entrega, dias), grano="mes")
    return gold.leer_consolidadas(spark, oro)


@consulta
def gold_tras_un_corte(spark, sf_dir):
    """A refresh that stopped after its first table; the next run date's refresh finishes it and does its own."""
    crudas, limpias, oro = (espacio(spark, n) for n in ("bronze", "silver", "gold"))
    ventas = feeds.ventas_ecommerce(spark, sf_dir)
    gold.procesar_gold(spark, limpias, oro, _entregar(spark, crudas, limpias, ventas, 0), grano="mes")
    segunda = _entregar(spark, crudas, limpias, _otra_version(ventas.where(_numero() % 3 == 0), 1, 2), 1)
    tercera = _entregar(spark, crudas, limpias, _otra_version(ventas.where(_numero() % 5 == 0), 40, 3), 2)
    trabajo = gold.preparar_gold(spark, limpias, oro, segunda, grano="mes")
    gold.escribir_vigentes(spark, oro, trabajo)
    gold.procesar_gold(spark, limpias, oro, tercera, grano="mes")
    return gold.leer_consolidadas(spark, oro)


@consulta
def bronze_origenes(spark, sf_dir):
    """Two streams with their own checkpoints and a plain drop of typed files on one run date, all there."""
    crudas = espacio(spark, "bronze")
    ventas = feeds.ventas_ecommerce(spark, sf_dir)
    _aterrizar(ventas.where(_numero() % 3 == 0), crudas, VENTAS_ECOMMERCE)
    for resto in (1, 2):
        microbatch.iniciar_microlotes(
            _flujo_json(spark, ventas.where(_numero() % 3 == resto), "eventos"),
            VENTAS_ECOMMERCE,
            bronze=crudas,
            checkpoint=espacio(spark, "checkpoint"),
            fecha=F.when(_numero() % 2 == 0, F.lit(RUN_DATE)).otherwise(F.lit(RUN_DATE)),
        ).awaitTermination()
    return silver.transformar_ventas_ecommerce(bronze.leer_bronze(spark, VENTAS_ECOMMERCE, crudas, RUN_DATE), RUN_TS)


@consulta
def silver_parcial(spark, sf_dir):
    """The whole job, then one feed alone again: the other feeds' rows and metrics are still there."""
    crudas, limpias = _lago(spark, sf_dir)
    silver.procesar_silver(spark, crudas, limpias, RUN_DATE, run_ts=RUN_TS, fuentes=(VENTAS_ECOMMERCE,))
    ventas = lake.leer_silver(spark, "ventas", limpias, RUN_DATE).groupBy("_fuente").count()
    medidas = lake.leer_silver(spark, "calidad", limpias, RUN_DATE).groupBy("tabla").count()
    return ventas.select(F.col("_fuente").alias("parte"), F.col("count").alias("filas")).unionByName(
        medidas.select(F.concat(F.lit("calidad/"), "tabla").alias("parte"), F.col("count").alias("filas"))
    )


@consulta
def silver_por_hora(spark, sf_dir):
    """Two arrival hours of one run date, the first of them run twice."""
    crudas, limpias = espacio(spark, "bronze"), espacio(spark, "silver")
    ventas = feeds.ventas_ecommerce(spark, sf_dir)
    for hora in (10, 11):
        parte = ventas.where(_numero() % 2 == hora - 10)
        parte.write.parquet(bronze.ruta_bronze(crudas, VENTAS_ECOMMERCE.tabla, RUN_DATE, hora=hora))
    for hora in (10, 11, 10):
        silver.procesar_silver(
            spark, crudas, limpias, RUN_DATE, run_ts=RUN_TS, fuentes=(VENTAS_ECOMMERCE,), hora=hora
        )
    dia = lake.leer_silver(spark, "ventas", limpias, RUN_DATE)
    return dia.groupBy("hour").agg(
        F.count(F.lit(1)).alias("n_ventas"), F.sum("monto_total").cast(gold.MONTO).alias("ventas_totales")
    )


@consulta
def reproceso_de_fechas(spark, sf_dir):
    """Three past run dates rebuilt in one job; tables and metrics per date."""
    crudas, limpias = espacio(spark, "bronze"), espacio(spark, "silver")
    ventas = feeds.ventas_ecommerce(spark, sf_dir)
    fechas = [RUN_DATE - timedelta(days=d) for d in range(3)]
    for resto, fecha in enumerate(fechas):
        # every date also has the sales of the one before, which are other run dates' business
        _aterrizar(ventas.where((_numero() % 3).isin(resto, (resto + 1) % 3)), crudas, VENTAS_ECOMMERCE, fecha)
    silver.reprocesar(spark, crudas, limpias, fechas, run_ts=RUN_TS, fuentes=(VENTAS_ECOMMERCE,))
    limpia = lake.leer_silver(spark, "calidad", limpias).where("etapa = 'silver_clean'")
    totales = lake.leer_silver(spark, "ventas", limpias, fechas[-1], fechas[0]).groupBy("day").agg(
        F.count(F.lit(1)).alias("n_ventas"), F.sum("monto_total").cast(gold.MONTO).alias("ventas_totales")
    )
    return totales.join(limpia.select("day", F.col("total").alias("medidas")), "day")


@consulta
def extraccion_con_solape(spark, sf_dir):
    """A first load that a seventh of the rows was committed too late for, then a window that looks back."""
    crudas = espacio(spark, "bronze")
    ventas = feeds.ventas_ecommerce(spark, sf_dir)
    medio, fin = datetime(2024, 1, 20), datetime(2024, 3, 1)
    a_tiempo = ventas.where(_numero() % 7 != 0)
    marca = incremental.ingerir(a_tiempo, VENTAS_ECOMMERCE, crudas, RUN_DATE, "created_at", None, medio)
    incremental.ingerir(
        ventas, VENTAS_ECOMMERCE, crudas, RUN_DATE, "created_at", marca, fin, solape=timedelta(days=30)
    )
    return silver.transformar_ventas_ecommerce(bronze.leer_bronze(spark, VENTAS_ECOMMERCE, crudas, RUN_DATE), RUN_TS)


@consulta
def devoluciones_repetidas(spark, sf_dir):
    """The store feed delivered twice on one run date: returns once, and the accounts close. The feed is worked out
    once; the second delivery is the first one as it was landed."""
    crudas, limpias = espacio(spark, "bronze"), espacio(spark, "silver")
    primera, otra = (bronze.ruta_bronze(crudas, VENTAS_TIENDAS.tabla, RUN_DATE, origen=o) for o in ("a", "b"))
    feeds.ventas_tiendas(spark, sf_dir).write.parquet(primera)
    spark.read.parquet(primera).write.parquet(otra)
    silver.procesar_silver(spark, crudas, limpias, RUN_DATE, run_ts=RUN_TS, fuentes=(VENTAS_TIENDAS,))
    vueltas = lake.leer_silver(spark, "ventas_apartadas", limpias, RUN_DATE).where("clase = 'devolucion'")
    medida = lake.leer_silver(spark, "calidad", limpias, RUN_DATE)
    cruda = medida.where("etapa = 'bronze_raw'").select(
        (F.col("total") - F.col("rechazadas") - F.col("devoluciones") - F.col("duplicadas")).alias("limpias")
    )
    return vueltas.agg(F.count(F.lit(1)).alias("devueltas"), F.count_distinct("venta_id").alias("llaves")).join(
        cruda, how="full"
    )


@consulta
def stream_sin_perdidas(spark, sf_dir):
    """Four event files, the newest sales first, with a horizon of ten days: every sale is on time or late."""
    salida, marcas = espacio(spark, "silver"), espacio(spark, "checkpoint")
    ventas = feeds.ventas_ecommerce(spark, sf_dir)
    dia = F.dayofmonth("created_at")
    semanas = ((24, 31), (16, 23), (8, 15), (1, 7))
    carpeta = _en_archivos(spark, *[ventas.where(dia.between(*semana)) for semana in semanas])
    flujo = microbatch.leer_eventos(spark, VENTAS_ECOMMERCE, carpeta, archivos_por_lote=1)
    limpias = stateful.conformar_flujo(flujo, VENTAS_ECOMMERCE, RUN_TS)
    stateful.escribir_primeras(limpias, salida, marcas, "10 days").awaitTermination()
    return stateful.leer_primeras(spark, salida).select("venta_id", "vendido_en", "parte")


def _en_archivos(spark, *partes) -> str:
    """Event files, one per frame, in the order in which a stream takes them; one task writes, all others read."""
    carpeta = espacio(spark, "eventos")
    for parte in partes:
        parte = parte.withColumn("created_at", F.col("created_at").cast("string"))
        parte.select(F.to_json(F.struct(*parte.columns)).alias("value")).repartition(1).write.mode("append").text(carpeta)
    return carpeta


@consulta
def stream_entregas_repetidas(spark, sf_dir):
    """Three files in the order of sale: the first half of the month, the whole month, the first half again. A
    sale is on time once; its copies are repeated ones, or late ones behind the horizon of five days."""
    salida, marcas = espacio(spark, "silver"), espacio(spark, "checkpoint")
    ventas = feeds.ventas_ecommerce(spark, sf_dir)
    mitad = ventas.where(F.dayofmonth("created_at") <= 15)
    flujo = microbatch.leer_eventos(
        spark, VENTAS_ECOMMERCE, _en_archivos(spark, mitad, ventas, mitad), archivos_por_lote=1
    )
    limpias = stateful.conformar_flujo(flujo, VENTAS_ECOMMERCE, RUN_TS)
    stateful.escribir_primeras(limpias, salida, marcas, "5 days").awaitTermination()
    return stateful.leer_primeras(spark, salida).groupBy("parte").agg(
        F.count(F.lit(1)).alias("filas"),
        F.count_distinct("venta_id").alias("ventas"),
        F.sum("monto_total").cast(gold.MONTO).alias("monto"),
    )


@consulta
def stream_totales_corregidos(spark, sf_dir):
    """Totals over four triggers: sales in two files, then corrections that take a third of them back and add a
    fifth once more. Each trigger writes the groups it changed."""
    salida, marcas = espacio(spark, "gold"), espacio(spark, "checkpoint")
    ventas = feeds.ventas_ecommerce(spark, sf_dir)
    menos = ventas.where(_numero() % 3 == 0).withColumn("total_amount", -F.col("total_amount"))
    carpeta = _en_archivos(
        spark, ventas.where(_numero() % 2 == 0), ventas.where(_numero() % 2 == 1), menos, ventas.where(_numero() % 5 == 0)
    )
    flujo = microbatch.leer_eventos(spark, VENTAS_ECOMMERCE, carpeta, archivos_por_lote=1)
    movimientos = stateful.movimientos(flujo, VENTAS_ECOMMERCE, RUN_TS)
    stateful.escribir_totales(stateful.totales_en_flujo(movimientos), salida, marcas, junta_cada=3).awaitTermination()
    return stateful.leer_totales(spark, salida)


@consulta
def gold_catalogo_del_dia(spark, sf_dir):
    """The one-day report as SQL over the published Gold table, by its partition."""
    _, limpias = _lago(spark, sf_dir)
    oro = espacio(spark, "gold")
    gold.procesar_gold(spark, limpias, oro, RUN_DATE, grano="mes")
    nombre = f"oro_{oro.rpartition('-')[2]}.ventas_consolidadas"
    lake.publicar_tabla(spark, nombre, oro, "ventas_consolidadas")
    return spark.sql(
        f"SELECT canal, fecha, ventas_totales FROM {nombre} WHERE periodo = date_format(:dia, 'yyyy-MM') AND fecha = :dia",
        args={"dia": DIA},
    )


@consulta
def gold_ventas_de_hoy(spark, sf_dir):
    """The report of the current date, over sales moved so that the fixed day is today."""
    hoy = silver_ventas(spark, sf_dir).withColumn(
        "vendido_en", F.col("vendido_en") + F.make_dt_interval(F.date_diff(F.current_date(), F.lit(DIA)))
    )
    return gold.ventas_del_dia(hoy).drop("fecha")


@consulta
def personas_enmascaradas(spark, sf_dir):
    """Names, addresses and card numbers by digest; a card is made up from the customer's key."""
    personas = spark.read.parquet(f"{sf_dir}/customer.parquet").select(
        "c_custkey",
        F.col("c_name").alias("nombre"),
        F.concat(F.lit(" Calle "), F.col("c_nationkey").cast("string"), F.lit(" No. 5 ")).alias("direccion"),
        F.concat(F.lit("4000 0000 0000 "), F.lpad(F.col("c_custkey").cast("string"), 4, "0")).alias("tarjeta"),
    )
    return mask_pii(personas, "nombre", "direccion", "tarjeta")


@consulta
def rechazos_inventario_erp(spark, sf_dir):
    """The stock feed with its own defects: blank stores and skus, missing ids and times."""
    n = F.col("inv_id").substr(F.lit(1), F.instr("inv_id", "-") - 1).cast("long")
    crudo = feeds.inventario(spark, sf_dir).withColumns(
        {
            "store_code": F.when(n % 11 == 0, F.lit("  ")).otherwise(F.col("store_code")),
            "product_code": F.when(n % 13 == 0, F.lit(None)).otherwise(F.col("product_code")),
            "last_updated": F.when(n % 17 == 0, F.lit(None)).otherwise(F.col("last_updated")),
            "inv_id": F.when(n % 19 == 0, F.lit("")).otherwise(F.col("inv_id")),
        }
    )
    return _motivos_texto(silver.rechazos(crudo, INVENTARIO_ERP, RUN_TS)).groupBy("motivos").count()


# --- Gold ------------------------------------------------------------------------------------------


@consulta
def gold_ventas_consolidadas(spark, sf_dir):
    return gold.ventas_consolidadas(silver_ventas(spark, sf_dir))


@consulta
def gold_ventas_consolidadas_mexico(spark, sf_dir):
    """The same by Mexico City business date."""
    return gold.ventas_consolidadas(silver_ventas(spark, sf_dir), zona="America/Mexico_City")


@consulta
def gold_ventas_del_dia(spark, sf_dir):
    return gold.ventas_del_dia(silver_ventas(spark, sf_dir), F.lit(DIA))


@consulta
def gold_sql_ventas_del_dia(spark, sf_dir):
    """The one-day report as SQL over a registered view."""
    lake.publicar_vista(gold.con_fecha(silver_ventas(spark, sf_dir)), "ventas_consolidadas")
    return spark.sql(
        """SELECT canal, fecha, CAST(sum(monto_total) AS DECIMAL(18,2)) AS ventas_totales
           FROM ventas_consolidadas WHERE fecha = :dia GROUP BY canal, fecha""",
        args={"dia": DIA},
    )


@consulta
def gold_ventas_por_tienda(spark, sf_dir):
    return gold.ventas_por_tienda(silver_ventas(spark, sf_dir))


@consulta
def gold_ventas_por_sku(spark, sf_dir):
    return gold.ventas_por_sku(silver_ventas(spark, sf_dir))


@consulta
def gold_ventas_por_tienda_sku_dia(spark, sf_dir):
    return gold.ventas_por_tienda_sku_dia(silver_ventas(spark, sf_dir))


@consulta
def gold_dim_tienda(spark, sf_dir):
    return gold.dim_tienda(silver_ventas(spark, sf_dir), silver_inventario(spark, sf_dir))


@consulta
def gold_dim_producto(spark, sf_dir):
    return gold.dim_producto(silver_ventas(spark, sf_dir))


@consulta
def gold_dim_fecha(spark, sf_dir):
    return gold.dim_fecha(silver_ventas(spark, sf_dir))


@consulta
def gold_estrella_ventas(spark, sf_dir):
    """Fact and dates from the sales, stores and products from the stock, as the star's job writes them; sales
    that those dimensions lack go to the unknown members.

    Silver is written once; fact and dimensions are read from it instead of being rebuilt each.
    """
    raiz = espacio(spark, "silver")
    silver_ventas(spark, sf_dir).write.parquet(f"{raiz}/ventas")
    silver_inventario(spark, sf_dir).write.parquet(f"{raiz}/inventario")
    ventas, stock = (spark.read.parquet(f"{raiz}/{t}") for t in ("ventas", "inventario"))
    hechos, productos = gold.hechos_ventas(ventas), gold.dim_producto(ventas, stock)
    return gold.consulta_estrella(hechos, gold.dim_tienda(stock), productos, gold.dim_fecha(ventas))


RENOMBRE = date(1995, 6, 16)


@consulta
def gold_tiendas_con_historia(spark, sf_dir):
    """Validity intervals of the stores' names; store T3 is renamed in the middle of a month."""
    return temporal.versiones_dimension(
        _tiendas_observadas(spark, sf_dir), "tienda_id", ("tienda_nombre",), tiempo="ultima_actualizacion"
    )


def _tiendas_observadas(spark, sf_dir):
    stock = validas(feeds.inventario(spark, sf_dir), INVENTARIO_ERP)
    otra = (F.col("tienda_id") == "T3") & (F.to_date("ultima_actualizacion") >= F.lit(RENOMBRE))
    nombre = F.concat("tienda_nombre", F.when(otra, F.lit(" Norte")).otherwise(F.lit("")))
    return stock.withColumn("tienda_nombre", nombre)


@consulta
def gold_estrella_con_historia(spark, sf_dir):
    """Sales by the name their store had on the day of the sale."""
    hechos = gold.hechos_ventas(silver_ventas(spark, sf_dir))
    return gold.consulta_estrella_con_historia(hechos, gold_tiendas_con_historia(spark, sf_dir))


def _caliente(df):
    """A third of the skus become one, and its rows one store's."""
    tercio = F.substring("sku", 5, 9).cast("int") % 3 == 0
    return df.withColumns(
        {
            "sku": F.when(tercio, F.lit("SKU-0")).otherwise(F.col("sku")),
            "tienda_id": F.when(tercio, F.lit("T1")).otherwise(F.col("tienda_id")),
        }
    )


@consulta
def ventas_con_existencias(spark, sf_dir):
    """Every store sale with the stock version current at its time; one store and sku hold a third of all rows."""
    ventas = _caliente(silver_ventas_tiendas(spark, sf_dir))
    ventas = ventas.select("venta_id", "tienda_id", "sku", "vendido_en", "cantidad")
    existencias = _caliente(validas(feeds.inventario(spark, sf_dir), INVENTARIO_ERP))
    return gold.ventas_con_existencias(ventas, existencias)


@consulta
def conteos_contra_existencias(spark, sf_dir):
    """Every physical count against the system's stock at the moment of counting."""
    conteos = validas(feeds.conteos(spark, sf_dir), CONTEOS_FISICOS)
    return gold.conteos_contra_existencias(conteos, validas(feeds.inventario(spark, sf_dir), INVENTARIO_ERP))


@consulta
def gold_niveles(spark, sf_dir):
    """Totals by store, sku and day on seven levels, written at once and read back."""
    oro = espacio(spark, "gold")
    gold.escribir_niveles(silver_ventas(spark, sf_dir), oro)
    return spark.read.parquet(f"{oro}/ventas_por_niveles")


@consulta
def bosquejos_por_corrida(spark, sf_dir):
    """Distinct sales and skus of ranges of run dates from stored sketches, checked against the exact counts."""
    oro, ventas = espacio(spark, "gold"), silver_ventas_ecommerce(spark, sf_dir)
    fechas = [RUN_DATE + timedelta(days=d) for d in range(3)]
    for resto, fecha in enumerate(fechas):
        parte = ventas.where((_numero("venta_id") % 4).isin(resto, resto + 1))  # a quarter comes twice
        bosquejo = bosquejos.bosquejar(parte, "canal", distintos="venta_id", frecuentes="sku")
        bosquejos.escribir_bosquejos(bosquejo, "bosquejos", oro, fecha)
    partes = []
    for desde, hasta, restos in ((0, 1, (0, 1, 2)), (1, 2, (1, 2, 3)), (0, 2, (0, 1, 2, 3))):
        rango = (fechas[desde], fechas[hasta])
        estimadas = bosquejos.contar_distintos(spark, "bosquejos", oro, *rango, por=("canal",))
        reales = ventas.where((_numero("venta_id") % 4).isin(*restos)).groupBy("canal").agg(
            F.count_distinct("venta_id").alias("reales")
        )
        cerca = F.abs(F.col("distintos") - F.col("reales")) <= F.ceil(F.col("reales") * bosquejos.margen())
        partes.append(
            estimadas.join(reales, "canal").select(
                F.lit(rango[0]).alias("desde"), F.lit(rango[1]).alias("hasta"), "canal", "filas", "reales", cerca.alias("cerca")
            )
        )
    return silver.unificar(*partes)


@consulta
def motivos_frecuentes(spark, sf_dir):
    """The reasons of the store feed's rejects over a range of run dates, from stored frequency sketches."""
    oro = espacio(spark, "gold")
    malas = silver.rechazos(feeds.ventas_tiendas(spark, sf_dir), VENTAS_TIENDAS, RUN_TS)
    numero = F.substring_index("venta_id", "-", 1).cast("long")
    # All run dates come from one feed, so it is worked out once; of the rejects only this is kept meanwhile.
    motivos = por_motivo(malas, "venta_id", (numero % 3).alias("resto")).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        for resto in range(3):
            bosquejo = bosquejos.bosquejar(
                motivos.where(F.col("resto") == resto), distintos="venta_id", frecuentes="motivo"
            )
            bosquejos.escribir_bosquejos(bosquejo, "motivos", oro, RUN_DATE + timedelta(days=resto))
    finally:
        motivos.unpersist()
    return bosquejos.mas_frecuentes(spark, "motivos", oro, RUN_DATE, RUN_DATE + timedelta(days=2), 20)


@consulta
def bronze_campos_nuevos(spark, sf_dir):
    """A stream whose events carry a coupon and a nested shipment from the middle of the month on: Silver is as
    ever, and the new fields are read back from Bronze."""
    crudas, limpias, marcas, carpeta = (espacio(spark, n) for n in ("bronze", "silver", "checkpoint", "eventos"))
    ventas = feeds.ventas_ecommerce(spark, sf_dir).withColumn("created_at", F.col("created_at").cast("string"))
    nueva = F.dayofmonth(F.col("created_at").cast("timestamp")) > 15
    con_mas = ventas.where(nueva).withColumns(
        {
            "cupon": _numero() % 5,
            "envio": F.struct(F.concat(F.lit("Z"), (_numero() % 3).cast("string")).alias("zona"), F.lit(True).alias("express")),
        }
    )
    for parte in (ventas.where(~nueva), con_mas):
        parte.select(F.to_json(F.struct(*parte.columns)).alias("value")).repartition(1).write.mode("append").text(carpeta)
    microbatch.ejecutar_microlotes(
        microbatch.leer_eventos_abiertos(spark, VENTAS_ECOMMERCE, carpeta, archivos_por_lote=1),
        VENTAS_ECOMMERCE,
        bronze=crudas,
        silver=limpias,
        checkpoint=marcas,
        fecha=F.lit(RUN_DATE),
        run_ts=RUN_TS,
    )
    guardadas = bronze.leer_bronze(spark, VENTAS_ECOMMERCE, crudas, RUN_DATE)
    extra = guardadas.select(
        F.col("order_id").alias("venta_id"),
        bronze.recuperar("cupon", "int").alias("cupon"),
        bronze.recuperar("envio", "string", ruta="$.zona").alias("zona"),
    )
    return lake.leer_silver(spark, "ventas", limpias, RUN_DATE).join(extra, "venta_id").groupBy("cupon", "zona").agg(
        F.count(F.lit(1)).alias("n_ventas"), F.sum("monto_total").cast(gold.MONTO).alias("ventas_totales")
    )


@consulta
def gold_ventas_vs_inventario(spark, sf_dir):
    return gold.ventas_vs_inventario(silver_ventas(spark, sf_dir), silver_inventario(spark, sf_dir))


@consulta
def ventas_vigentes(spark, sf_dir):
    """Two runs saw the same store sales; the later one counts."""
    crudo = feeds.ventas_tiendas(spark, sf_dir)
    corridas = [silver.transformar_ventas_tiendas(crudo, RUN_TS + timedelta(days=d)) for d in (0, 1)]
    return gold.ventas_vigentes(silver.unificar(*corridas))


@consulta
def sku_conformidad(spark, sf_dir):
    """Which systems know each sku, over their valid rows."""
    return gold.sku_conformidad(
        pos=validas(feeds.ventas_tiendas(spark, sf_dir), VENTAS_TIENDAS),
        ecommerce=validas(feeds.ventas_ecommerce(spark, sf_dir), VENTAS_ECOMMERCE),
        erp=validas(feeds.inventario(spark, sf_dir), INVENTARIO_ERP),
        conteos=validas(feeds.conteos(spark, sf_dir), CONTEOS_FISICOS),
    )


@consulta
def conciliacion_inventario(spark, sf_dir):
    return gold.conciliar_inventario(silver_inventario(spark, sf_dir), silver_conteos(spark, sf_dir))
