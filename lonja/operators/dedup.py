"""Keep the latest row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _lista(x: str | Sequence[str]) -> list[str]:
    return [x] if isinstance(x, str) else list(x)


def deduplicar(df: DataFrame, llave: str | Sequence[str], orden: str | Sequence[str]) -> DataFrame:
    """One row per `llave`: the highest `orden`, NULLs last, all other columns breaking ties.

    Columns of `orden` the frame lacks (a feed without stores, say) are skipped; the first one must
    exist. The full tie-break makes the survivor independent of partitioning. With `== 1` on a row number
    Spark keeps one row per key *before* the exchange (WindowGroupLimit), so a hot key reaches its
    reducer as at most one row per map task.
    """
    primero = _lista(orden)[0]
    llave, orden = _lista(llave), [c for c in _lista(orden) if c in df.columns]
    if not orden or orden[0] != primero:
        raise ValueError(f"order column {primero!r} not found")
    desempate = [c for c in sorted(df.columns) if c not in {*llave, *orden}]
    ventana = Window.partitionBy(*llave).orderBy(*[F.col(c).desc_nulls_last() for c in [*orden, *desempate]])
    return df.withColumn("_posicion", F.row_number().over(ventana)).where("_posicion = 1").drop("_posicion")
