"""Who writes: a name for every stream, kept with its checkpoint."""

from __future__ import annotations

from time import time_ns
from uuid import uuid4

from pyspark.sql import SparkSession

from lonja.sources.lake import rutas_existentes


def identidad(spark: SparkSession, checkpoint: str, nombre: str) -> str:
    """The stream's origin: a name made up with the checkpoint and kept in it. Names made later sort later.

    A second receiver has another checkpoint, and a lost checkpoint is replaced by one with another name, so
    no stream can write where another one has.
    """
    carpeta = f"{checkpoint.rstrip('/')}/lonja"
    halladas = rutas_existentes(spark, f"{carpeta}/origen=*")
    if not halladas:
        nuevo = f"{nombre}-{time_ns():020d}-{uuid4().hex[:12]}"
        camino = spark._jvm.org.apache.hadoop.fs.Path(f"{carpeta}/origen={nuevo}")
        camino.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(camino)
        halladas = rutas_existentes(spark, f"{carpeta}/origen=*")
    return min(halladas).rpartition("=")[2]
