"""What held at a time: the version current when something happened, and dimensions with validity intervals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lonja.workspace import espacio

VERSION, HECHO = 0, 1


def al_momento(
    hechos: DataFrame,
    versiones: DataFrame,
    llaves: Sequence[str],
    *,
    tiempo: str,
    desde: str,
    valores: Sequence[str],
    desempate: Sequence[str] = (),
    particiones: int | None = None,
) -> DataFrame:
    """Every row of `hechos` with the `valores` of the version of its keys that was current at its `tiempo`.

    That is the one with the latest `desde` not after it; of equal times the highest `desempate`, then `valores`.
    Without such a version, a time or a key the values are NULL; no row of `hechos` is lost or repeated.

    Facts and versions are united, dealt into ranges of (keys, time) and written, so a hot key is cut by time into
    as many ranges as its rows fill. Inside a range the last version is carried forward. A range that begins in the
    middle of a key takes over the last version of the ranges before it, one row each. No join meets a key's rows
    with its versions, and none of them is gathered. Keys and times travel once, and only versions are sorted to
    find the last one of a range.
    """
    spark, llaves = hechos.sparkSession, list(llaves)
    n = particiones or int(spark.conf.get("spark.sql.shuffle.partitions"))
    desempate = [c for c in [*desempate, *valores] if c in versiones.columns]
    tipos, suyos = dict(hechos.dtypes), dict(versiones.dtypes)
    # Columns of the facts that the union holds already, in their own type.
    comunes = {c: c for c in llaves if tipos[c] == suyos[c]} | ({tiempo: "_t"} if tipos[tiempo] == suyos[desde] else {})
    resto = [c for c in hechos.columns if c not in comunes]
    if not resto:
        comunes, resto = {}, hechos.columns
    usables = versiones.where(F.col(desde).isNotNull()).select(
        *llaves,
        F.col(desde).alias("_t"),
        F.lit(VERSION).alias("_tipo"),
        F.struct(*[F.col(c).alias(f"d{i}") for i, c in enumerate(desempate)]).alias("_orden"),
        F.struct(*valores).alias("_valor"),
        F.lit(0).cast("long").alias("_fila"),
    )
    filas = hechos.select(
        *llaves,
        F.col(tiempo).alias("_t"),
        F.lit(HECHO).alias("_tipo"),
        F.monotonically_increasing_id().alias("_fila"),
        F.struct(*resto).alias("_hecho"),
    )
    orden = [*llaves, "_t", "_tipo", "_orden", "_fila"]
    dealt = usables.unionByName(filas, allowMissingColumns=True).repartitionByRange(n, *orden)
    ruta = espacio(spark, "al-momento")
    dealt.withColumn("_parte", F.spark_partition_id()).write.parquet(ruta)
    juntas = spark.read.parquet(ruta)
    version = F.when(F.col("_tipo") == VERSION, F.struct(*llaves, "_valor"))
    # One row per range; their number is that of the ranges.
    ultima = F.max_by(F.struct(*llaves, "_valor"), F.struct(*llaves, "_t", "_orden")).alias("_ultima")
    ultimas = juntas.where(F.col("_tipo") == VERSION).groupBy("_parte").agg(ultima)
    bordes = juntas.select("_parte").distinct().join(ultimas, "_parte", "left")
    antes = Window.orderBy("_parte").rowsBetween(Window.unboundedPreceding, -1)
    heredadas = bordes.select("_parte", F.last("_ultima", ignorenulls=True).over(antes).alias("_heredada"))
    dentro = Window.partitionBy("_parte").orderBy(*orden[:-1]).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    vistas = juntas.withColumn("_vista", F.last(version, ignorenulls=True).over(dentro)).where(F.col("_tipo") == HECHO)
    vistas = vistas.join(heredadas, "_parte").withColumn("_vista", F.coalesce("_vista", "_heredada"))
    suya = F.col("_t").isNotNull()
    for c in llaves:
        suya = suya & (F.col(f"_vista.{c}") == F.col(c))
    propias = [F.col(comunes.get(c, f"_hecho.{c}")).alias(c) for c in hechos.columns]
    return vistas.select(*propias, *[F.when(suya, F.col(f"_vista._valor.{c}")).alias(c) for c in valores])


def versiones_dimension(
    observadas: DataFrame, llave: str, atributos: Sequence[str], *, tiempo: str
) -> DataFrame:
    """A dimension with history: one row per key and stretch of days with the same attributes.

    `desde` is the first day a stretch was observed, `hasta` (exclusive) that of the next one, NULL for the current.
    A day counts with its last observation, of equal times the greatest. Observations are reduced to one per key
    and day before they are ordered, so a key that most rows share costs the window its days only.
    """
    estado = F.struct(*atributos)
    dias = (
        observadas.where(F.col(llave).isNotNull() & F.col(tiempo).isNotNull())
        .groupBy(llave, F.to_date(tiempo).alias("desde"))
        .agg(F.max(F.struct(F.col(tiempo).alias("t"), estado.alias("e"))).alias("u"))
        .select(llave, "desde", F.col("u.e").alias("_e"))
    )
    orden = Window.partitionBy(llave).orderBy("desde")
    cambia = F.lag("_e").over(orden).isNull() | ~F.lag("_e").over(orden).eqNullSafe(F.col("_e"))
    islas = dias.withColumn("_cambia", cambia).where("_cambia")
    return islas.select(llave, "_e.*", "desde", F.lead("desde").over(orden).alias("hasta"))


def con_version(hechos: DataFrame, versiones: DataFrame, llave: str, fecha: str) -> DataFrame:
    """Facts with the attributes of the version of their date; those before the first version, or without, keep NULLs."""
    v = versiones.withColumnsRenamed({llave: "_llave", "desde": "_desde", "hasta": "_hasta"})
    vale = (F.col(fecha) >= F.col("_desde")) & (F.col("_hasta").isNull() | (F.col(fecha) < F.col("_hasta")))
    return hechos.join(v, (F.col(llave) == F.col("_llave")) & vale, "left").drop("_llave", "_desde", "_hasta")
