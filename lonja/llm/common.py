"""Helpers shared by the operators: shipping the package, written intermediate tables, table paths."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from functools import cache
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from lonja.workspace import espacio

ROOT = Path(__file__).resolve().parents[2]


@cache
def _zip() -> str:
    """This package as a zip file, for `addPyFile`."""
    path = os.path.join(tempfile.mkdtemp(prefix="lonja-"), "lonja.zip")
    with zipfile.ZipFile(path, "w") as z:
        for f in sorted((ROOT / "lonja").rglob("*.py")):
            z.write(f, f.relative_to(ROOT))
    return path


def ship(spark: SparkSession) -> None:
    """Makes this package importable by the Python workers unless PYTHONPATH already does."""
    if str(ROOT) in os.environ.get("PYTHONPATH", "").split(os.pathsep):
        return
    added = spark.sparkContext._python_includes
    if "lonja.zip" not in added:
        spark.sparkContext.addPyFile(_zip())


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """Writes `df` as Parquet in the shared folder and reads it back: cuts the lineage, survives lost executors."""
    path = espacio(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Deletes the folder behind a table that `written` made and nothing reads any more."""
    files = df.inputFiles()
    if files:
        jvm, conf = df.sparkSession._jvm, df.sparkSession._jsc.hadoopConfiguration()
        folder = jvm.org.apache.hadoop.fs.Path(files[0]).getParent()
        folder.getFileSystem(conf).delete(folder, True)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def grouped(rows: DataFrame, keys: list[str], work: Callable, schema: str, *, least: int = 1) -> DataFrame:
    """Runs `work(pa.Table)` on every group of at least `least` rows with equal, non-null numbers as `keys`.

    Each task reads a stream sorted by the keys and holds one group at a time; `work` gives record batches.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def flush():
            if held and sum(b.num_rows for b in held) >= least:
                yield from work(pa.Table.from_batches(held))

        for batch in batches:
            if not batch.num_rows:
                continue
            new = np.zeros(batch.num_rows, bool)
            new[0] = not held or any(held[-1].column(k)[-1].as_py() != batch.column(k)[0].as_py() for k in keys)
            for k in keys:
                c = batch.column(k).to_numpy(zero_copy_only=False)
                new[1:] |= c[1:] != c[:-1]
            heads = np.append(np.flatnonzero(new), batch.num_rows)
            if heads[0]:
                held.append(batch.slice(0, heads[0]))
            for lo, hi in zip(heads[:-1].tolist(), heads[1:].tolist(), strict=True):
                yield from flush()
                held = [batch.slice(lo, hi - lo)]
        yield from flush()

    dealt = rows.repartition(partitions(rows.sparkSession), *keys).sortWithinPartitions(*keys)
    return dealt.mapInArrow(run, schema)
