"""Hot keys: a third of the rows share one order, product and store, and nothing may be broadcast."""

from __future__ import annotations

from pathlib import Path

import pyarrow.compute as pc
import pyarrow.parquet as pq
import pytest
from comparar import conectar, filas_duckdb, filas_spark

import __spark_entry__ as entrada

AJUSTES = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8000",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16000",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.files.maxPartitionBytes": "30000",
    "spark.sql.shuffle.partitions": "16",
}


@pytest.fixture(scope="module")
def caliente(spark, sf_dir, tmp_path_factory):
    carpeta = tmp_path_factory.mktemp("caliente")
    for archivo in Path(sf_dir).glob("*.parquet"):
        tabla = pq.read_table(archivo)
        if archivo.stem == "lineitem":
            tercio = pc.equal(pc.bit_wise_and(tabla["l_quantity"].cast("int64"), 3), 1)
            for columna, valor in (("l_orderkey", 1), ("l_partkey", 5), ("l_suppkey", 7)):
                i = tabla.schema.get_field_index(columna)
                tabla = tabla.set_column(i, columna, pc.if_else(tercio, valor, tabla[columna]))
        pq.write_table(tabla, carpeta / archivo.name, row_group_size=500)
    previos = {k: spark.conf.get(k, None) for k in AJUSTES}
    for k, v in AJUSTES.items():
        spark.conf.set(k, v)
    yield str(carpeta)
    for k, v in previos.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.mark.parametrize(
    "nombre",
    [
        "silver_ventas_tiendas",
        "silver_inventario",
        "rechazos_ventas",
        "calidad",
        "gold_estrella_ventas",
        "gold_ventas_vs_inventario",
        "conciliacion_inventario",
        "sku_conformidad",
        "duplicados_fuente",
        "ventas_vigentes",
    ],
)
def test_results_hold_with_hot_keys(spark, caliente, nombre):
    columnas, filas = filas_spark(entrada.queries()[nombre](spark, caliente))
    esperadas, datos = filas_duckdb(conectar(caliente), entrada.oracle_sql()[nombre])
    assert columnas == esperadas and filas == datos


def test_joins_split_the_hot_key(spark, caliente):
    df = entrada.queries()["silver_ventas_tiendas"](spark, caliente)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("SortMergeJoin(skew=true)") >= 1
    assert plan.split("SortMergeJoin")[0].count("WindowGroupLimit") == 2
