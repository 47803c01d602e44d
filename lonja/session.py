"""Session settings the pipelines rely on, and how to size shuffles for the data at hand."""

from __future__ import annotations

from math import ceil

from pyspark.sql import SparkSession

MB = 1 << 20


def particiones_shuffle(bytes_entrada: int, *, objetivo: int = 128 * MB, minimo: int = 200) -> int:
    """Shuffle partitions so that one holds about `objetivo` bytes.

    AQE merges partitions that turn out small but never splits the ones of a window or an aggregate,
    so the starting number must fit the largest shuffle (the deduplication, at most the input).
    """
    return max(minimo, ceil(bytes_entrada / objetivo))


def configurar(
    constructor: SparkSession.Builder, *, bytes_entrada: int | None = None, particiones: int | None = None
) -> SparkSession.Builder:
    """Settings that matter here: UTC, AQE with skew handling, and enough shuffle partitions."""
    n = particiones or (particiones_shuffle(bytes_entrada) if bytes_entrada else None)
    ajustes = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 * MB),
        # A few partitions of a task are written side by side without sorting by them first.
        "spark.sql.maxConcurrentOutputFileWriters": "4",
        "spark.ui.enabled": "false",
    }
    if n:
        ajustes["spark.sql.shuffle.partitions"] = str(n)
    for clave, valor in ajustes.items():
        constructor = constructor.config(clave, valor)
    return constructor
