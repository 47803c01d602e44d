"""Times the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query is planned and run to a no-op sink once to warm up and then REPS times; the best is kept.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import SparkSession  # noqa: E402

from lonja import feeds  # noqa: E402
from lonja.contracts import INVENTARIO_ERP, VENTAS_ECOMMERCE, VENTAS_TIENDAS  # noqa: E402
from lonja.plans.queries import CONSULTAS, RUN_DATE, RUN_TS  # noqa: E402
from lonja.plans.silver import procesar_silver  # noqa: E402
from lonja.session import configurar  # noqa: E402
from lonja.sources.bronze import ruta_bronze  # noqa: E402
from lonja.workspace import espacio  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
REPS = int(os.environ.get("BENCH_REPS", "2"))
TITULARES = [
    "silver_ventas",
    "silver_inventario",
    "gold_ventas_consolidadas",
    "gold_estrella_ventas",
    "gold_ventas_vs_inventario",
    "rechazos_ventas",
    "calidad",
    "ventas_por_dia_podadas",
    "stream_ventas_ecommerce",
    "sku_conformidad",
]


def medir(accion) -> float:
    tiempos = []
    for _ in range(REPS + 1):
        inicio = time.perf_counter()
        accion()
        tiempos.append(time.perf_counter() - inicio)
    return round(min(tiempos[1:]), 3)


def main() -> None:
    spark = (
        configurar(SparkSession.builder.master(f"local[{CPUS}]").appName("bench"), particiones=int(CPUS))
        .config("spark.driver.memory", "16g")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    tiempos = {}
    for nombre in TITULARES:
        tiempos[nombre] = medir(
            lambda n=nombre: CONSULTAS[n](spark, SF_DIR).write.format("noop").mode("overwrite").save()
        )
    bronze = espacio(spark, "bench-bronze")
    for feed, fuente in (
        (feeds.ventas_tiendas, VENTAS_TIENDAS),
        (feeds.ventas_ecommerce, VENTAS_ECOMMERCE),
        (feeds.inventario, INVENTARIO_ERP),
    ):
        feed(spark, SF_DIR).repartition(int(CPUS)).write.parquet(ruta_bronze(bronze, fuente.tabla, RUN_DATE))
    silver = espacio(spark, "bench-silver")
    tiempos["trabajo_silver_completo"] = medir(
        lambda: procesar_silver(spark, bronze, silver, RUN_DATE, run_ts=RUN_TS)
    )
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_query_time",
                "value": round(sum(tiempos.values()), 3),
                "unit": "sec",
                "queries": tiempos,
                "sf": Path(SF_DIR).name.removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
