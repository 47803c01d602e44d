"""The Silver and Gold jobs over written tables: accounting, reruns, partitions, missing input."""

from __future__ import annotations

import shutil
from collections import Counter
from datetime import date, timedelta

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from lonja import feeds, job
from lonja.contracts import FUENTES
from lonja.plans import gold, silver
from lonja.sources import bronze, lake

DIA = date(2025, 4, 13)
FEEDS = {
    "ventas_tiendas": feeds.ventas_tiendas,
    "ventas_ecommerce": feeds.ventas_ecommerce,
    "inventario": feeds.inventario,
}


@pytest.fixture(scope="module")
def lago(spark, sf_dir, tmp_path_factory):
    raiz = tmp_path_factory.mktemp("lago")
    b, s = str(raiz / "bronze"), str(raiz / "silver")
    for tabla, feed in FEEDS.items():
        feed(spark, sf_dir).write.parquet(bronze.ruta_bronze(b, tabla, DIA))
    filas = silver.procesar_silver(spark, b, s, DIA)
    return b, s, filas


def contenido(df, *fuera):
    return Counter(map(tuple, df.drop("_procesado_en", *fuera).collect()))


def test_every_raw_row_is_accounted_for(spark, lago):
    _, s, filas = lago
    crudas = lake.leer_silver(spark, "calidad", s, DIA).where("etapa = 'bronze_raw'").collect()
    por_tabla = {f["tabla"]: f for f in crudas}
    limpias = {
        f["_fuente"].removeprefix("bronze/"): f["count"]
        for t in ("ventas", "inventario")
        for f in lake.leer_silver(spark, t, s, DIA).groupBy("_fuente").count().collect()
    }
    for tabla, m in por_tabla.items():
        assert m["total"] == limpias[tabla] + m["rechazadas"] + m["devoluciones"] + m["duplicadas"]
    tiendas = por_tabla["ventas_tiendas"]
    assert (tiendas["total"], tiendas["devoluciones"], limpias["ventas_tiendas"]) == (6000, 1606, 2578)
    assert filas["ventas"] == sum(v for k, v in limpias.items() if k != "inventario")
    assert filas["ventas_apartadas"] == lake.leer_silver(spark, "ventas_apartadas", s, DIA).count()


def test_keys_are_unique_after_the_job(spark, lago):
    _, s, _ = lago
    ventas = lake.leer_silver(spark, "ventas", s)
    assert ventas.count() == ventas.select("canal", "venta_id").distinct().count()


def test_rerun_and_other_dates(spark, lago, sf_dir):
    b, s, filas = lago
    manana = DIA + timedelta(days=1)
    feeds.ventas_ecommerce(spark, sf_dir).write.mode("overwrite").parquet(
        bronze.ruta_bronze(b, "ventas_ecommerce", manana)
    )
    antes = contenido(lake.leer_silver(spark, "ventas", s, DIA))
    silver.procesar_silver(spark, b, s, manana, permitir_vacio=True)
    assert contenido(lake.leer_silver(spark, "ventas", s, DIA)) == antes
    assert silver.reprocesar(spark, b, s, [DIA])[str(DIA)] == filas
    assert contenido(lake.leer_silver(spark, "ventas", s, DIA)) == antes
    assert lake.leer_silver(spark, "ventas", s, DIA, manana).count() == sum(antes.values()) + 202
    assert lake.leer_silver(spark, "ventas", s, manana).count() == 202


def test_missing_feed_stops_before_writing(spark, lago, tmp_path):
    b, _, _ = lago
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        silver.procesar_silver(spark, b, str(tmp_path / "silver"), "2030-01-01")
    assert not (tmp_path / "silver").exists()


def test_a_run_without_rows_empties_its_partition(spark, lago, tmp_path):
    _, s, _ = lago
    ventas = lake.leer_silver(spark, "ventas", s, DIA).drop(*lake.DIA)
    raiz = str(tmp_path)
    assert lake.escribir_silver(ventas, "v", raiz, DIA) > 0
    assert lake.escribir_silver(ventas, "v", raiz, DIA + timedelta(days=1)) > 0
    assert lake.escribir_silver(ventas.limit(0), "v", raiz, DIA) == 0
    assert lake.leer_silver(spark, "v", raiz, DIA).count() == 0
    assert lake.leer_silver(spark, "v", raiz, DIA + timedelta(days=1)).count() == ventas.count()


def test_a_class_without_rows_empties_only_its_part(spark, tmp_path):
    raiz, clases = str(tmp_path), {"clase": ("a", "b")}
    df = spark.createDataFrame([("a", 1), ("b", 2)], "clase string, x int")
    assert lake.escribir_silver(df, "t", raiz, DIA, por=clases) == 2
    assert lake.escribir_silver(df.where("clase = 'a'"), "t", raiz, DIA, por=clases) == 1
    assert [f["clase"] for f in lake.leer_silver(spark, "t", raiz, DIA).collect()] == ["a"]


def test_pruned_read_uses_partition_filters(spark, lago):
    _, s, _ = lago
    for df in (lake.leer_silver(spark, "ventas", s, DIA), lake.leer_silver(spark, "ventas", s, DIA, DIA)):
        plan = df.select("sku")._jdf.queryExecution().toString()
        assert "PartitionFilters: [isnotnull(year" in plan or "make_date(year" in plan.split("PartitionFilters")[1]
        assert "ReadSchema: struct<sku:string>" in plan


def test_hour_partition_and_compaction(spark, lago, tmp_path):
    _, s, _ = lago
    ventas = lake.leer_silver(spark, "ventas", s, DIA).drop(*lake.DIA)
    lake.escribir_silver(ventas.repartition(16), "v", str(tmp_path), DIA, hora=10, compactar=True)
    carpeta = tmp_path / "v" / "year=2025" / "month=4" / "day=13" / "hour=10"
    assert len(list(carpeta.glob("*.parquet"))) == 1
    assert spark.read.parquet(str(carpeta)).count() == ventas.count()


def test_backfill_writes_one_file_per_date(spark, lago, tmp_path):
    _, s, _ = lago
    linea = lake.leer_silver(spark, "ventas", s, DIA).where("canal = 'ecommerce'").drop(*lake.DIA)
    lake.escribir_por_fecha(linea.repartition(16), "v", str(tmp_path), "vendido_en")
    carpetas = [d for d in (tmp_path / "v").glob("year=*/month=*/day=*")]
    assert len(carpetas) == 30
    assert all(len(list(d.glob("*.parquet"))) == 1 for d in carpetas)


def test_gold_job_and_catalog(spark, lago, tmp_path):
    _, s, _ = lago
    oro = str(tmp_path / "gold")
    n = gold.procesar_gold(spark, s, oro, DIA, grano="mes")
    assert n == gold.procesar_gold(spark, s, oro, DIA, grano="mes") == gold.leer_consolidadas(spark, oro).count()
    lake.publicar_tabla(spark, "oro.ventas_consolidadas", oro, "ventas_consolidadas")
    total = spark.sql("SELECT sum(ventas_totales) AS t FROM oro.ventas_consolidadas").first()["t"]
    esperado = lake.leer_silver(spark, "ventas", s, DIA).agg(F.sum("monto_total").alias("t")).first()["t"]
    assert total == esperado


def test_today_is_the_default_date(spark, lago, run_ts):
    _, s, _ = lago
    hoy = lake.leer_silver(spark, "ventas", s, DIA).withColumn("vendido_en", F.current_timestamp())
    assert gold.ventas_del_dia(hoy).count() == 2


def test_session_zone_is_checked(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/Mexico_City")
    try:
        with pytest.raises(ValueError, match="timeZone"):
            silver.exigir_utc(spark)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_plans_stay_in_the_jvm(spark, sf_dir, run_ts):
    ventas = silver.unificar(
        silver.transformar_ventas_tiendas(feeds.ventas_tiendas(spark, sf_dir), run_ts),
        silver.transformar_ventas_ecommerce(feeds.ventas_ecommerce(spark, sf_dir), run_ts),
    )
    plan = gold.ventas_consolidadas(ventas)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan
    # Constants and hashes are added above the deduplication exchange.
    assert "sha2" not in plan and "bronze/ventas" not in plan


def test_command_line(capsys):
    a = job.argumentos(["silver", "--bronze", "b", "--silver", "s", "--run-date", "2025-04-13"])
    assert (a.capa, a.run_date, a.permitir_vacio) == ("silver", DIA, False)
    with pytest.raises(SystemExit):
        job.argumentos(["silver", "--bronze", "b"])


def test_feeds_are_registered():
    assert set(FUENTES) == {"ventas_tiendas", "ventas_ecommerce", "inventario", "conteos_fisicos"}


def test_every_feed_is_read_once(spark, sf_dir, tmp_path, monkeypatch):
    """Once a table is written its Bronze is not needed any more: all outputs come from one classification."""
    b, s = str(tmp_path / "bronze"), str(tmp_path / "silver")
    for tabla, feed in FEEDS.items():
        feed(spark, sf_dir).write.parquet(bronze.ruta_bronze(b, tabla, DIA))
    esperadas = silver.procesar_silver(spark, b, str(tmp_path / "otra"), DIA)
    escribir = silver.escribir_silver

    def y_borrar(df, tabla, *a, **k):
        filas = escribir(df, tabla, *a, **k)
        for feed in (f.tabla for f in FUENTES.values() if f.destino == tabla):
            shutil.rmtree(tmp_path / "bronze" / feed, ignore_errors=True)
        return filas

    monkeypatch.setattr(silver, "escribir_silver", y_borrar)
    assert silver.procesar_silver(spark, b, s, DIA) == esperadas
    for tabla in ("ventas", "ventas_apartadas", "inventario", "calidad"):
        una, otra = (lake.leer_silver(spark, tabla, r, DIA) for r in (s, str(tmp_path / "otra")))
        una, otra = (df.select([F.col(c).cast("string").alias(c) for c in df.columns]) for df in (una, otra))
        assert contenido(una) == contenido(otra)
    assert not spark.sparkContext._jsc.getPersistentRDDs().size()


def test_a_feed_is_released_when_its_table_is_written(spark, lago, tmp_path, monkeypatch):
    b, _, _ = lago
    escribir, guardados = silver.escribir_silver, {}
    antes = spark.sparkContext._jsc.getPersistentRDDs().size()

    def anotada(df, tabla, *a, **k):
        filas = escribir(df, tabla, *a, **k)
        guardados[tabla] = spark.sparkContext._jsc.getPersistentRDDs().size() - antes
        return filas

    monkeypatch.setattr(silver, "escribir_silver", anotada)
    silver.procesar_silver(spark, b, str(tmp_path), DIA)
    assert guardados["ventas"] == 2 and guardados["inventario"] == 1 and guardados["calidad"] == 0
