from __future__ import annotations

import sys
from datetime import datetime
from pathlib import Path

import pytest

RAIZ = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(RAIZ))
sys.path.insert(0, str(RAIZ / "tests"))

from pyspark.sql import SparkSession  # noqa: E402

from lonja.session import configurar  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    base = tmp_path_factory.mktemp("spark")
    constructor = SparkSession.builder.master("local[4]").appName("tests")
    sesion = (
        configurar(constructor, particiones=4)
        .config("spark.checkpoint.dir", str(base / "checkpoints"))
        .config("spark.sql.warehouse.dir", str(base / "warehouse"))
        .config("spark.driver.memory", "4g")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    sesion.sparkContext.setLogLevel("ERROR")
    yield sesion
    sesion.stop()


@pytest.fixture
def run_ts():
    return datetime(2025, 4, 13, 10, 0)


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"
