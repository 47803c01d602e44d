"""Order-insensitive comparison of a Spark result with DuckDB over the same Parquet files."""

from __future__ import annotations

from collections import Counter
from datetime import datetime
from decimal import Decimal
from pathlib import Path

import duckdb


def conectar(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for archivo in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {archivo.stem} AS SELECT * FROM '{archivo}'")
    return con


def _valor(v):
    if isinstance(v, datetime) and v.tzinfo is not None:
        return v.replace(tzinfo=None)
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, (Decimal, bool)) or v is None:
        return v
    return v


def filas_duckdb(con, texto: str) -> tuple[list[str], Counter]:
    cur = con.execute(texto)
    columnas = [d[0] for d in cur.description]
    orden = sorted(range(len(columnas)), key=lambda i: columnas[i])
    datos = Counter(tuple(_valor(f[i]) for i in orden) for f in cur.fetchall())
    return sorted(columnas), datos


def filas_spark(df) -> tuple[list[str], Counter]:
    columnas = sorted(df.columns)
    datos = Counter(tuple(_valor(v) for v in f) for f in df.select(*columnas).collect())
    return columnas, datos
