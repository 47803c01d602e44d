"""A fresh folder on storage every executor sees, for written tables and stream checkpoints."""

from __future__ import annotations

import tempfile
from functools import cache
from uuid import uuid4

from pyspark.sql import SparkSession


@cache
def _local() -> str:
    return tempfile.mkdtemp(prefix="lonja-")


def espacio(spark: SparkSession, nombre: str = "trabajo") -> str:
    """A new path under `spark.checkpoint.dir`.

    Without that setting a temporary folder is used, on a local master only: on a cluster the driver's
    disk is not the executors'.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        base = _local()
    return f"{base.rstrip('/')}/lonja/{nombre}-{uuid4().hex}"
