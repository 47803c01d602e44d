"""Silver -> Gold: business aggregates, a star schema and sales against stock.

Only the total by channel and date is a given; the other aggregates, the star's columns and the
reconciliation rules are definitions of this package.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date
from functools import reduce
from operator import and_
from uuid import uuid4

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lonja.contracts import ORDEN_VENTAS
from lonja.functions import fecha_negocio
from lonja.operators.dedup import deduplicar
from lonja.operators.temporal import al_momento, con_version
from lonja.sources import indice
from lonja.sources.indice import CLAVE
from lonja.sources.lake import (
    CODEC,
    DIA,
    NOTA,
    anotar,
    borrar,
    escribir_particiones,
    escribir_silver,
    leer_dias,
    leer_nota,
    leer_silver,
    mover_particiones,
    rutas_existentes,
    vaciar,
)

MONTO = "decimal(18,2)"
PATRON = {"fecha": "yyyy-MM-dd", "mes": "yyyy-MM"}
DESCONOCIDO = "desconocido"


def con_fecha(ventas: DataFrame, zona: str | None = None) -> DataFrame:
    """Adds the business date: the UTC date of the sale, or the date in `zona`."""
    return ventas.withColumn("fecha", fecha_negocio(F.col("vendido_en"), zona))


def _totales(ventas: DataFrame, *llaves: str) -> DataFrame:
    return ventas.groupBy(*llaves).agg(
        F.sum("monto_total").cast(MONTO).alias("ventas_totales"),
        F.sum("cantidad").alias("unidades"),
        F.count(F.lit(1)).alias("n_ventas"),
    )


def ventas_consolidadas(ventas: DataFrame, *, zona: str | None = None) -> DataFrame:
    """Sales total by channel and date."""
    return _totales(con_fecha(ventas, zona), "canal", "fecha").select("canal", "fecha", "ventas_totales")


def ventas_del_dia(ventas: DataFrame, dia: Column | None = None, *, zona: str | None = None) -> DataFrame:
    """The consolidated sales of one date, today unless given. The filter runs before the aggregation."""
    dia = F.current_date() if dia is None else dia
    con = con_fecha(ventas, zona).where(F.col("fecha") == dia)
    return _totales(con, "canal", "fecha").select("canal", "fecha", "ventas_totales")


def ventas_por_tienda(ventas: DataFrame) -> DataFrame:
    return _totales(ventas.where(F.col("tienda_id").isNotNull()), "tienda_id")


def ventas_por_sku(ventas: DataFrame) -> DataFrame:
    return _totales(ventas, "sku")


def ventas_por_tienda_sku_dia(ventas: DataFrame, *, zona: str | None = None) -> DataFrame:
    return _totales(con_fecha(ventas, zona), "canal", "tienda_id", "sku", "fecha")


def ventas_vigentes(ventas: DataFrame) -> DataFrame:
    """Across run dates, the version of every sale that counts: the same rule as inside a run date.

    Of equal versions the last processed is kept.
    """
    return deduplicar(ventas, CLAVE, (*ORDEN_VENTAS, "_procesado_en"))


NIVELES = {
    "tienda_sku_dia": ("tienda_id", "sku", "fecha"),
    "tienda_dia": ("tienda_id", "fecha"),
    "sku_dia": ("sku", "fecha"),
    "tienda": ("tienda_id",),
    "sku": ("sku",),
    "dia": ("fecha",),
    "total": (),
}


def ventas_por_niveles(ventas: DataFrame, *, zona: str | None = None) -> DataFrame:
    """The totals of all `NIVELES` from one scan and one exchange.

    `nivel` and `grupo` (the grouping id: a bit per left-out key, the store's the highest) tell a level's missing
    key from a sale that has none. Rows are reduced per level before the exchange.
    """
    llaves = ("tienda_id", "sku", "fecha")
    agrupadas = con_fecha(ventas, zona).groupingSets([[F.col(c) for c in n] for n in NIVELES.values()], *llaves)
    totales = agrupadas.agg(
        F.sum("monto_total").cast(MONTO).alias("ventas_totales"),
        F.sum("cantidad").alias("unidades"),
        F.count(F.lit(1)).alias("n_ventas"),
        F.grouping_id(*llaves).cast("int").alias("grupo"),
    )
    nombre = F.lit(None).cast("string")
    for nivel, presentes in NIVELES.items():
        bits = sum(1 << (len(llaves) - 1 - i) for i, c in enumerate(llaves) if c not in presentes)
        nombre = F.when(F.col("grupo") == bits, F.lit(nivel)).otherwise(nombre)
    return totales.withColumn("nivel", nombre)


def escribir_niveles(ventas: DataFrame, gold: str, *, zona: str | None = None) -> int:
    """Write all levels at once, one partition each; a level that no sale belongs to is emptied."""
    esperadas = [{"nivel": n} for n in NIVELES]
    return escribir_particiones(ventas_por_niveles(ventas, zona=zona), "ventas_por_niveles", gold, ["nivel"], esperadas)


# --- star schema -----------------------------------------------------------------------------------


def dim_tienda(*tablas: DataFrame) -> DataFrame:
    """Stores seen in sales or stock. The greatest name wins, so the result is deterministic."""
    vistas = reduce(DataFrame.unionByName, [t.select("tienda_id", "tienda_nombre") for t in tablas])
    con_id = vistas.where(F.col("tienda_id").isNotNull())
    return con_id.groupBy("tienda_id").agg(F.max("tienda_nombre").alias("tienda_nombre"))


def dim_producto(ventas: DataFrame, inventario: DataFrame | None = None) -> DataFrame:
    """Products seen in sales and, if given, in stock: first and last sale, and how many stores stock it."""
    vistas = con_fecha(ventas).select("sku", "fecha", F.lit(None).cast("string").alias("tienda_id"))
    if inventario is None:
        return vistas.groupBy("sku").agg(F.min("fecha").alias("primera_venta"), F.max("fecha").alias("ultima_venta"))
    stock = inventario.select("sku", F.lit(None).cast("date").alias("fecha"), "tienda_id")
    return vistas.unionByName(stock).groupBy("sku").agg(
        F.min("fecha").alias("primera_venta"),
        F.max("fecha").alias("ultima_venta"),
        F.count_distinct("tienda_id").alias("tiendas_con_stock"),
    )


def dim_fecha(ventas: DataFrame, *, zona: str | None = None) -> DataFrame:
    """Calendar of the dates that occur."""
    return (
        con_fecha(ventas, zona)
        .select("fecha")
        .distinct()
        .select(
            "fecha",
            F.year("fecha").alias("anio"),
            F.month("fecha").alias("mes"),
            F.quarter("fecha").alias("trimestre"),
            F.weekday("fecha").alias("dia_semana"),
        )
    )


def hechos_ventas(ventas: DataFrame, *, zona: str | None = None) -> DataFrame:
    """Fact at sale grain: natural keys to the dimensions plus the measures."""
    return con_fecha(ventas, zona).select(
        "venta_id", "canal", "fecha", "tienda_id", "sku", "cantidad", "precio_unitario", "monto_total"
    )


def consulta_estrella(
    hechos: DataFrame, tiendas: DataFrame, productos: DataFrame, fechas: DataFrame
) -> DataFrame:
    """Sales by channel, store name, number of stores that stock the product, and month.

    The fact is reduced to its foreign keys first (partial aggregation, so neither a hot store nor the
    store-less online rows pile up), and only that summary is joined. Keys that a dimension lacks belong to
    its unknown member: no sale is lost. Broadcasting is left to Spark's size threshold.
    """
    resumen = hechos.groupBy("canal", "tienda_id", "sku", "fecha").agg(
        F.sum("monto_total").alias("monto"), F.sum("cantidad").alias("unidades")
    )
    nombre = F.coalesce("tienda_nombre", F.lit(DESCONOCIDO)).alias("tienda_nombre")
    surtido = F.coalesce("tiendas_con_stock", F.lit(0)).alias("tiendas_con_stock")
    return (
        resumen.join(fechas.select("fecha", "anio", "mes"), "fecha", "left")
        .join(tiendas, "tienda_id", "left")
        .join(productos.select("sku", "tiendas_con_stock"), "sku", "left")
        .groupBy("canal", nombre, surtido, "anio", "mes")
        .agg(F.sum("monto").cast(MONTO).alias("ventas_totales"), F.sum("unidades").alias("unidades"))
    )


def consulta_estrella_con_historia(hechos: DataFrame, tiendas: DataFrame) -> DataFrame:
    """Sales by channel, month and the name a store had on the day of the sale (`versiones_dimension`).

    The fact is reduced to store and day first. Online sales, and those from before a store was first seen, belong
    to the unknown member.
    """
    resumen = hechos.groupBy("canal", "tienda_id", "fecha").agg(
        F.sum("monto_total").alias("monto"), F.sum("cantidad").alias("unidades")
    )
    nombre = F.coalesce("tienda_nombre", F.lit(DESCONOCIDO)).alias("tienda_nombre")
    con_nombre = con_version(resumen, tiendas, "tienda_id", "fecha")
    return con_nombre.groupBy("canal", nombre, F.year("fecha").alias("anio"), F.month("fecha").alias("mes")).agg(
        F.sum("monto").cast(MONTO).alias("ventas_totales"), F.sum("unidades").alias("unidades")
    )


# --- sales and stock -------------------------------------------------------------------------------


def ventas_vs_inventario(ventas: DataFrame, inventario: DataFrame, *, como: str = "left") -> DataFrame:
    """Sales per store and sku next to the current stock.

    Both sides hold one row per key when they meet, so the join cannot be skewed by a hot sku.
    """
    vendido = _totales(ventas, "tienda_id", "sku")
    stock = inventario.select("tienda_id", "sku", "stock_disponible", "stock_reservado")
    return vendido.join(stock, ["tienda_id", "sku"], como)


EXISTENCIAS = ("stock_disponible", "stock_reservado", "ultima_actualizacion")


def ventas_con_existencias(ventas: DataFrame, existencias: DataFrame) -> DataFrame:
    """Every sale with the stock its store had of the product at that moment, from all stock versions."""
    return al_momento(
        ventas,
        existencias,
        ("tienda_id", "sku"),
        tiempo="vendido_en",
        desde="ultima_actualizacion",
        valores=EXISTENCIAS,
        desempate=("inventario_id",),
    )


def conteos_contra_existencias(conteos: DataFrame, existencias: DataFrame) -> DataFrame:
    """Every physical count against the stock the system had at the moment of counting; NULL if it had none."""
    vistos = al_momento(
        conteos,
        existencias,
        ("tienda_id", "sku"),
        tiempo="contado_en",
        desde="ultima_actualizacion",
        valores=EXISTENCIAS,
        desempate=("inventario_id",),
    )
    en_sistema = F.col("stock_disponible") + F.col("stock_reservado")
    return vistos.select(
        "conteo_id",
        "tienda_id",
        "sku",
        "contado",
        "contado_en",
        en_sistema.alias("en_sistema"),
        (F.col("contado") - en_sistema).alias("diferencia"),
    )


def sku_conformidad(**sistemas: DataFrame) -> DataFrame:
    """For each sku, which systems know it, and whether all of them do.

    One exchange: the flags are or-ed per sku on the map side, so it carries one row per sku and task
    whatever the number of rows, and no set is collected.
    """
    nombres = list(sistemas)
    vistos = [
        df.select("sku", *[F.lit(n == nombre).alias(f"en_{n}") for n in nombres]) for nombre, df in sistemas.items()
    ]
    banderas = [F.bool_or(f"en_{n}").alias(f"en_{n}") for n in nombres]
    unidos = reduce(DataFrame.unionByName, vistos).groupBy("sku").agg(*banderas)
    return unidos.withColumn("conforme", reduce(and_, [F.col(f"en_{n}") for n in nombres]))


def conciliar_inventario(inventario: DataFrame, conteos: DataFrame) -> DataFrame:
    """System stock against physical counts, per store and sku, with the corrected stock.

    Both inputs hold one row per key (latest). Physical units are compared with available plus
    reserved units; the count, where there is one, becomes the corrected figure.
    """
    sistema = inventario.select(
        "tienda_id", "sku", (F.col("stock_disponible") + F.col("stock_reservado")).alias("en_sistema")
    )
    fisico = conteos.select("tienda_id", "sku", "contado")
    diferencia = F.col("contado") - F.col("en_sistema")
    estado = (
        F.when(F.col("contado").isNull(), "sin_conteo")
        .when(F.col("en_sistema").isNull(), "sin_sistema")
        .when(diferencia > 0, "sobrante")
        .when(diferencia < 0, "faltante")
        .otherwise("coincide")
    )
    return sistema.join(fisico, ["tienda_id", "sku"], "full_outer").select(
        "tienda_id",
        "sku",
        "en_sistema",
        "contado",
        diferencia.alias("diferencia"),
        estado.alias("estado"),
        F.coalesce("contado", "en_sistema").alias("stock_corregido"),
    )


# --- the Gold job ----------------------------------------------------------------------------------


def _con_corrida(ventas: DataFrame) -> DataFrame:
    """Silver rows with their sale date and the run date they were written for."""
    return con_fecha(ventas).withColumn("_corrida", F.make_date(*map(F.col, DIA))).drop(*DIA, "hour")


def procesar_gold(
    spark: SparkSession,
    silver: str,
    gold: str,
    run_dates: date | str | Iterable[date | str],
    *,
    desde: date | str | None = None,
    detalle: bool = False,
    grano: str = "fecha",
) -> int:
    """Refresh Gold for what the given run dates brought; returns the rows of consolidated sales written.

    `ventas_vigentes` holds every sale once, whatever run dates and hours delivered it, under its sale date. Only
    the sale dates (or months) that sales of these run dates are on, or were on, are rewritten, with their
    aggregates. `detalle` also writes the totals by store and sku. The work has two halves, `preparar_gold` and
    `aplicar_gold`; what a stopped run had prepared is applied first, whichever run dates are given. One refresh of
    a Gold folder runs at a time.
    """
    reanudar_gold(spark, gold)
    trabajo = preparar_gold(spark, silver, gold, run_dates, desde=desde, detalle=detalle, grano=grano)
    return aplicar_gold(spark, gold, trabajo) if trabajo else 0


def _pendientes(gold: str) -> str:
    return f"{gold.rstrip('/')}/_pendientes"


def reanudar_gold(spark: SparkSession, gold: str) -> None:
    """Finish refreshes that were prepared and not applied to the end; drop those that were not even prepared."""
    for carpeta in sorted(rutas_existentes(spark, f"{_pendientes(gold)}/*")):
        if rutas_existentes(spark, f"{carpeta}/{NOTA}"):
            aplicar_gold(spark, gold, carpeta)
        else:
            borrar(spark, carpeta)


def _orden(alias: str) -> Column:
    return F.struct(*[F.col(f"{alias}.{c}") for c in (*ORDEN_VENTAS, "_corrida")])


def preparar_gold(
    spark: SparkSession,
    silver: str,
    gold: str,
    run_dates: date | str | Iterable[date | str],
    *,
    desde: date | str | None = None,
    detalle: bool = False,
    grano: str = "fecha",
) -> str | None:
    """Work out a refresh and write it beside Gold, which stays as it is; the folder of the work, None if there is none.

    The index of sale keys says which sale dates the touched sales were on. The version that counts is the best of
    what the run dates deliver now and of Gold's own version, so history isn't read. Only where Gold's version came
    from these run dates and they now bring a lesser one or none, other run dates' versions are read, from just
    those the index names, not before `desde`. The note is written last: with it the work is complete. In a Gold
    folder without history the deliveries are the result, which is then written once.
    """
    dias = [run_dates] if isinstance(run_dates, (date, str)) else list(run_dates)
    dias = sorted({date.fromisoformat(d) if isinstance(d, str) else d for d in dias})
    if not dias:
        return None
    if rutas_existentes(spark, f"{gold.rstrip('/')}/ventas_vigentes/periodo=*") and not indice.tramos(spark, gold):
        indexar_gold(spark, silver, gold)
    trabajo = f"{_pendientes(gold)}/{uuid4().hex}"
    periodo, propia = F.date_format("fecha", PATRON[grano]), F.col("_corrida").isin(dias)

    def guardar(df: DataFrame, nombre: str, **vistas: Column) -> tuple[DataFrame, dict]:
        """The frame as written, and what the writing stage saw."""
        vista = Observation(nombre)
        medida = df.observe(vista, F.count(F.lit(1)).alias("n"), *[c.alias(n) for n, c in vistas.items()])
        medida.write.option("compression", CODEC).parquet(f"{trabajo}/{nombre}")
        return spark.read.schema(df.schema).parquet(f"{trabajo}/{nombre}"), vista.get

    corrida = _con_corrida(leer_dias(spark, "ventas", silver, dias))
    entregadas = deduplicar(corrida, CLAVE, (*ORDEN_VENTAS, "_corrida"))

    def terminar(resultado: DataFrame, periodos: list[str] | None) -> str:
        """The result by period, the index and the note; the periods are those of the result unless given."""
        vista, ruta = Observation("resultado"), f"{trabajo}/ventas_vigentes"
        resultado = resultado.select(*CLAVE, *[c for c in resultado.columns if c not in CLAVE])
        medido = resultado.hint("rebalance", "periodo").observe(vista, F.collect_set("periodo").alias("periodos"))
        medido.write.option("compression", CODEC).partitionBy("periodo").parquet(ruta)
        con_filas = set(vista.get["periodos"])
        partes = indice.preparar(spark, gold, indice.entradas(corrida), dias, f"{trabajo}/indice")
        nota = {"periodos": {p: p in con_filas for p in sorted(con_filas if periodos is None else periodos)}}
        nota["esquema"] = resultado.drop("periodo").schema.jsonValue()
        anotar(spark, trabajo, {**nota, "partes": partes, "detalle": detalle, "grano": grano})
        return trabajo

    if not indice.tramos(spark, gold):
        return terminar(entregadas.withColumn("periodo", periodo), None)
    entregadas, vistas = guardar(
        indice.con_cubo(entregadas), "entregadas", cubos=F.collect_set("cubo"), periodos=F.collect_set(periodo)
    )
    tocadas, cubos, estan = entregadas.select(*CLAVE, "cubo"), vistas["cubos"], vistas["periodos"]
    antes = indice.buscar_corridas(spark, gold, dias)
    if antes is not None:  # what they delivered before this rerun may be taken back
        tocadas, vistas = guardar(
            tocadas.unionByName(antes.select(*CLAVE, "cubo")).distinct(), "tocadas", cubos=F.collect_set("cubo")
        )
        cubos = vistas["cubos"]
    elegidas, estaban = entregadas.drop("cubo"), []
    conocidas = indice.buscar_llaves(spark, gold, tocadas, cubos)
    if conocidas is not None:
        conocidas, vistas = guardar(conocidas, "conocidas", periodos=F.collect_set(periodo))
        ganadoras = _vigentes(spark, gold, vistas["periodos"], elegidas).join(tocadas, [*CLAVE], "left_semi")
        ganadoras, vistas = guardar(
            ganadoras, "ganadoras", periodos=F.collect_set("periodo"), propias=F.count_if(propia)
        )
        estaban, candidatas = vistas["periodos"], elegidas.unionByName(ganadoras.where(~propia).drop("periodo"))
        if vistas["propias"]:
            perdidas = ganadoras.where(propia).alias("g").join(entregadas.alias("e"), [*CLAVE], "left")
            perdidas = perdidas.where(F.col("e._corrida").isNull() | (_orden("e") < _orden("g"))).select(*CLAVE)
            otras = conocidas.where(~propia).join(perdidas, [*CLAVE], "left_semi").select("_corrida").distinct()
            if desde is not None:
                otras = otras.where(F.col("_corrida") >= F.lit(str(desde)).cast("date"))
            otras = sorted(d for (d,) in otras.collect())
            if otras:
                viejas = _con_corrida(leer_dias(spark, "ventas", silver, otras))
                candidatas = candidatas.unionByName(viejas.join(perdidas, [*CLAVE], "left_semi"))
        if vistas["n"]:
            elegidas = deduplicar(candidatas, CLAVE, (*ORDEN_VENTAS, "_corrida"))
            elegidas, vistas = guardar(elegidas, "elegidas", periodos=F.collect_set(periodo))
            estan = vistas["periodos"]
    periodos = sorted({*estan, *estaban})
    siguen = _vigentes(spark, gold, periodos, elegidas).join(tocadas, [*CLAVE], "left_anti")
    return terminar(siguen.unionByName(elegidas.withColumn("periodo", periodo)), periodos)


def _vigentes(spark: SparkSession, gold: str, periodos: list[str], como: DataFrame) -> DataFrame:
    """Gold's sales of some periods, with `periodo`; without any, no rows of the columns of `como`."""
    ruta = f"{gold.rstrip('/')}/ventas_vigentes"
    carpetas = rutas_existentes(spark, *[f"{ruta}/periodo={p}" for p in periodos])
    esquema = StructType([f for f in como.schema if f.name != "periodo"]).add("periodo", "string")
    if not carpetas:
        return spark.createDataFrame([], esquema)
    return spark.read.schema(esquema).option("basePath", ruta).parquet(*carpetas)


def escribir_vigentes(spark: SparkSession, gold: str, trabajo: str) -> None:
    """Put the prepared sales that count in the place of Gold's, by period; one that lost all its sales is emptied."""
    nota, ruta = leer_nota(spark, trabajo), f"{gold.rstrip('/')}/ventas_vigentes"
    partes = {f"periodo={p}": con_filas for p, con_filas in nota["periodos"].items()}
    mover_particiones(spark, f"{trabajo}/ventas_vigentes", ruta, partes)
    for p in (p for p, con_filas in nota["periodos"].items() if not con_filas):
        vaciar(spark.createDataFrame([], StructType.fromJson(nota["esquema"])), ruta, {"periodo": p})


def _preparadas(spark: SparkSession, gold: str, trabajo: str, nota: dict) -> DataFrame:
    """The prepared sales that count, with `periodo`; a period that `escribir_vigentes` has moved is read from Gold."""
    esquema, carpetas = StructType.fromJson(nota["esquema"]), []
    for p in (p for p, con_filas in nota["periodos"].items() if con_filas):
        lugares = [f"{raiz}/ventas_vigentes/periodo={p}" for raiz in (trabajo, gold.rstrip("/"))]
        carpetas += rutas_existentes(spark, *lugares)[:1]
    leidas = spark.read.schema(esquema).parquet(*carpetas) if carpetas else spark.createDataFrame([], esquema)
    return leidas.withColumn("periodo", F.date_format("fecha", PATRON[nota["grano"]]))


def aplicar_gold(spark: SparkSession, gold: str, trabajo: str) -> int:
    """Put prepared work into Gold; returns the rows of consolidated sales.

    Aggregates are worked out from the prepared sales, which then take the place of Gold's as they are, by period, as
    the index does. Every step replaces whole partitions and can be repeated, so whatever a stop left behind is right
    after the next try. The folder goes last.
    """
    nota, filas = leer_nota(spark, trabajo), 0
    esperadas = [{"periodo": p} for p in nota["periodos"]]
    if esperadas:
        vigentes = _preparadas(spark, gold, trabajo, nota)
        periodo = F.date_format("fecha", PATRON[nota["grano"]]).alias("periodo")
        if nota["detalle"]:
            por_sku = _totales(vigentes, "canal", "tienda_id", "sku", "fecha").select("*", periodo)
            escribir_particiones(por_sku, "ventas_por_tienda_sku_dia", gold, ["periodo"], esperadas)
        consolidadas = _totales(vigentes, "canal", "fecha").select("canal", "fecha", "ventas_totales", periodo)
        filas = escribir_particiones(consolidadas, "ventas_consolidadas", gold, ["periodo"], esperadas)
        escribir_vigentes(spark, gold, trabajo)
    indice.reemplazar(spark, gold, nota["partes"], f"{trabajo}/indice")
    borrar(spark, trabajo)
    return filas


def indexar_gold(spark: SparkSession, silver: str, gold: str) -> None:
    """Build the index of sale keys anew from all of Silver, for a Gold folder that has none."""
    ventas = _con_corrida(leer_silver(spark, "ventas", silver))
    dias = sorted(d for (d,) in ventas.select("_corrida").distinct().collect())
    trabajo = f"{_pendientes(gold)}/{uuid4().hex}"
    partes = indice.preparar(spark, gold, indice.entradas(ventas), dias, f"{trabajo}/indice")
    anotar(spark, trabajo, {"periodos": {}, "partes": partes, "detalle": False, "grano": "fecha"})
    aplicar_gold(spark, gold, trabajo)


def procesar_dimensiones(spark: SparkSession, silver: str, gold: str, run_date: date | str) -> None:
    """The star's dimensions as of a run date: stores and products from Gold's sales and that date's stock."""
    ventas = leer_gold(spark, "ventas_vigentes", gold)
    stock = leer_silver(spark, "inventario", silver, run_date)
    for nombre, dim in (
        ("dim_tienda", dim_tienda(ventas, stock)),
        ("dim_producto", dim_producto(ventas, stock)),
        ("dim_fecha", dim_fecha(ventas)),
    ):
        escribir_silver(dim, nombre, gold, run_date)


def leer_gold(spark: SparkSession, tabla: str, gold: str, periodos: Iterable[str] | None = None) -> DataFrame:
    """A Gold table, whole or for some periods, whose folders alone are listed. `fecha` is an ordinary column."""
    ruta = f"{gold.rstrip('/')}/{tabla}"
    carpetas = [ruta] if periodos is None else [f"{ruta}/periodo={p}" for p in periodos]
    return spark.read.option("basePath", ruta).parquet(*carpetas).drop("periodo")


def leer_consolidadas(spark: SparkSession, gold: str, dia: date | str | None = None) -> DataFrame:
    """Sales total by channel and date, of all dates or of one, for which only its period is read."""
    if dia is None:
        return leer_gold(spark, "ventas_consolidadas", gold)
    ruta = f"{gold.rstrip('/')}/ventas_consolidadas"
    hay = [p for p in (str(dia), str(dia)[:7]) if rutas_existentes(spark, f"{ruta}/periodo={p}")]
    leidas = leer_gold(spark, "ventas_consolidadas", gold, hay or None)
    return leidas.where(F.col("fecha") == F.lit(str(dia)).cast("date"))
