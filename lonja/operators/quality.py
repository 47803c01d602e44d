"""Quality metrics as rows: one aggregation per feed, no separate action per number."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lonja.contracts import Fuente
from lonja.operators.conform import DEVOLUCION, RECHAZO, VALIDA, falta, reglas


def log_quality(
    df: DataFrame, stage: str, tabla: str, *, sku: str = "sku", monto: str | None = "monto_total"
) -> DataFrame:
    """One row: table, stage, row count, NULL skus and NULL amounts (0 if there is no amount column).

    `sku` and `monto` name the columns to look at, since raw feeds use other names than Silver.
    """
    nulos_monto = F.count_if(F.col(monto).isNull()) if monto in df.columns else F.lit(0).cast("long")
    return df.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col(sku).isNull()).alias("nulos_sku"),
        nulos_monto.alias("nulos_monto"),
    ).select(F.lit(tabla).alias("tabla"), F.lit(stage).alias("etapa"), "total", "nulos_sku", "nulos_monto")


def metricas_crudas(fuente: Fuente) -> dict[str, Column]:
    """Aggregates over classified rows; usable in `agg` and, for a write, in `observe`."""
    monto_nulo = F.lit(False)
    if fuente.monto:
        monto_nulo = falta(fuente, f"nulo:{fuente.monto}")
    netas_nulas = F.col("_netas").isNull() if fuente.stock else F.lit(False)
    netas_negativas = F.col("_netas") < 0 if fuente.stock else F.lit(False)
    return {
        "total": F.count(F.lit(1)),
        "nulos_sku": F.count_if(F.col("sku").isNull()),
        "nulos_monto": F.count_if(monto_nulo),
        "validas": F.count_if(F.col("_clase") == VALIDA),
        "devoluciones": F.count_if(F.col("_clase") == DEVOLUCION),
        "rechazadas": F.count_if(F.col("_clase") == RECHAZO),
        "stock_desconocido": F.count_if(netas_nulas),
        "stock_negativo": F.count_if(netas_negativas),
    }


def filas_calidad(metricas: DataFrame) -> DataFrame:
    """Raw and clean metric rows per row of `tabla`, `metricas_crudas`, `unicas` and `devueltas`.

    `devueltas` counts returns once per key; their repeats are duplicates like those of sales, so that
    total = clean + rejects + returns + duplicates. Clean rows passed the checks for a present sku and a
    positive amount, so their NULL counts are 0 by construction. Other columns are kept.
    """
    otras = [c for c in metricas.columns if c in ("fecha",)]
    cero = F.lit(0).cast("long")
    comunes = ["total", "nulos_sku", "nulos_monto", "rechazadas", "devoluciones", "duplicadas"]
    stock = ["stock_desconocido", "stock_negativo"]
    cruda = F.struct(
        F.lit("bronze_raw").alias("etapa"),
        *[F.col(c) for c in comunes[:-2]],
        F.col("devueltas").alias("devoluciones"),
        (F.col("validas") - F.col("unicas") + F.col("devoluciones") - F.col("devueltas")).alias("duplicadas"),
        *stock,
    )
    limpia = F.struct(
        F.lit("silver_clean").alias("etapa"),
        F.col("unicas").alias("total"),
        *[cero.alias(c) for c in [*comunes[1:], *stock]],
    )
    return metricas.select("tabla", *otras, F.inline(F.array(cruda, limpia)))


def calidad_fuente(clasificado: DataFrame, fuente: Fuente, *, por: tuple[str, ...] = ()) -> DataFrame:
    """All metrics of one feed in one pass, for each value of `por` if given.

    Surviving rows are counted as distinct keys among valid rows and among returns, which Spark aggregates
    partially before each exchange: no window, no second scan, and a hot key is one row per task.
    """
    unicas = {
        nombre: F.count_distinct(F.when(F.col("_clase") == clase, F.struct(*fuente.llave))).alias(nombre)
        for nombre, clase in (("unicas", VALIDA), ("devueltas", DEVOLUCION))
    }
    metricas = {n: c.alias(n) for n, c in metricas_crudas(fuente).items()}
    medido = clasificado.groupBy(*por).agg(*metricas.values(), *unicas.values())
    return filas_calidad(medido.withColumn("tabla", F.lit(fuente.tabla)))


def frecuencia_motivos(clasificado: DataFrame, fuente: Fuente) -> DataFrame:
    """How often each rule of a feed is broken: `motivo`, `filas`, `proporcion` of all rows. One pass."""
    nombres = reglas(fuente)
    medido = clasificado.agg(
        F.count(F.lit(1)).alias("total"), *[F.count_if(falta(fuente, r)).alias(r) for r in nombres]
    )
    filas = [
        F.struct(
            F.lit(r).alias("motivo"),
            F.col(f"`{r}`").alias("filas"),
            F.try_divide(F.col(f"`{r}`"), F.col("total")).alias("proporcion"),
        )
        for r in nombres
    ]
    return medido.select(F.inline(F.array(*filas)))


def duplicados(df: DataFrame, llave: list[str]) -> DataFrame:
    """How many keys occur how many times: `copias`, `llaves`, `filas`."""
    por_llave = df.groupBy(*llave).agg(F.count(F.lit(1)).alias("copias"))
    return por_llave.groupBy("copias").agg(
        F.count(F.lit(1)).alias("llaves"), F.sum("copias").alias("filas")
    )
