"""Command line of the jobs: `spark-submit lonja/job.py silver --bronze ... --silver ... --run-date ...`."""

from __future__ import annotations

import argparse
from collections.abc import Sequence
from datetime import date

from pyspark.sql import SparkSession

from lonja.plans.gold import procesar_gold
from lonja.plans.silver import procesar_silver
from lonja.session import configurar


def argumentos(argv: Sequence[str] | None = None) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="lonja")
    sub = p.add_subparsers(dest="capa", required=True)
    s = sub.add_parser("silver", help="Bronze -> Silver for one run date")
    s.add_argument("--bronze", required=True)
    s.add_argument("--formato", default="parquet", choices=("parquet", "json", "csv"))
    s.add_argument("--permitir-vacio", action="store_true", help="a missing feed counts as empty")
    g = sub.add_parser("gold", help="Silver -> Gold for one run date")
    g.add_argument("--gold", required=True)
    for x in (s, g):
        x.add_argument("--silver", required=True)
        x.add_argument("--run-date", required=True, type=date.fromisoformat)
        x.add_argument("--bytes-entrada", type=int, help="input size, to size the shuffles")
    return p.parse_args(argv)


def main(argv: Sequence[str] | None = None) -> None:
    a = argumentos(argv)
    sesion = SparkSession.builder.appName(f"lonja-{a.capa}")
    spark = configurar(sesion, bytes_entrada=a.bytes_entrada).getOrCreate()
    if a.capa == "silver":
        formatos = dict.fromkeys(("ventas_tiendas", "ventas_ecommerce", "inventario"), a.formato)
        filas = procesar_silver(
            spark, a.bronze, a.silver, a.run_date, formatos=formatos, permitir_vacio=a.permitir_vacio
        )
        for tabla, n in filas.items():
            print(f"{a.run_date} {tabla}: {n}")
    else:
        print(f"{a.run_date} ventas_consolidadas: {procesar_gold(spark, a.silver, a.gold, a.run_date)}")


if __name__ == "__main__":
    main()
