"""Exact arithmetic on vectors of whole numbers: scaling, squared distances, and sums that Spark adds up.

Vectors travel as the doubles they came as and are scaled by a power of two in the tasks, so no component is lost
whatever its size. Small ones are 64-bit integers; where a distance could pass 63 bits, Python integers are used.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import floor, isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LIMB = 40
SUMS = "slot long, limb int, s long"


def usable(vector: Column) -> Column:
    """Whether a vector is there and free of null, NaN and infinite components; an empty one is."""
    good = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(vector.isNotNull() & good, F.lit(False))


def by_length(vectors: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, positions, matrix of doubles) for each length among the vectors of a batch."""
    flat = vectors.flatten().to_numpy(zero_copy_only=False)
    at = vectors.offsets.to_numpy() - vectors.offsets[0].as_py()
    size = np.diff(at)
    for d in np.unique(size).tolist():
        rows = np.flatnonzero(size == d)
        yield d, rows, flat[(at[rows][:, None] + np.arange(d)).ravel()].reshape(len(rows), d)


def whole(x: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x), `scale` a power of two: 64-bit integers, or Python integers if one passes 2**53."""
    with np.errstate(over="ignore"):
        y = np.floor(x * scale)
    if not y.size or np.abs(y).max() < 2.0**53:
        return y.astype(np.int64)
    exact = [int(a) * scale if abs(a) >= 2.0**53 else floor(a * scale) for a in x.ravel().tolist()]
    return np.array(exact, object).reshape(x.shape)


def fitting(*matrices: np.ndarray) -> list[np.ndarray]:
    """The matrices as 64-bit integers if all squared distances between their rows fit, else as Python integers."""
    limit = isqrt((1 << 62) // max(1, matrices[0].shape[-1])) // 2
    small = all(not m.size or (m.min() > -limit and m.max() < limit) for m in matrices)
    return [m.astype(np.int64 if small else object) for m in matrices]


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances along the last axis, exactly; the arrays are from `fitting`."""
    apart = a - b
    return (apart * apart).sum(axis=-1)


class Sums:
    """Exact sums of whole numbers in numbered slots, as rows of limbs that a plain `sum` adds up."""

    def __init__(self, slots: int):
        self.totals = [0] * slots

    def add(self, slot: int, values: np.ndarray) -> None:
        for i, value in enumerate(values.tolist()):
            self.totals[slot + i] += value

    def rows(self) -> list[tuple[int, int, int]]:
        """(slot, limb, value), the last limb of a slot being signed."""
        out = []
        for slot, total in enumerate(self.totals):
            limb = 0
            while total:
                last = -(1 << LIMB) <= total < 1 << LIMB
                out.append((slot, limb, total if last else total & (1 << LIMB) - 1))
                total, limb = 0 if last else total >> LIMB, limb + 1
        return out


def column_sums(v: np.ndarray) -> np.ndarray:
    """Sums of the columns without overflow."""
    if v.dtype == object or not v.size or np.abs(v).max() < (1 << 62) // len(v):
        return v.sum(axis=0)
    return v.astype(object).sum(axis=0)


def collected(sums: DataFrame, slots: int) -> list[int]:
    """The totals of all slots; the driver gets one row per slot and limb."""
    totals = [0] * slots
    for slot, limb, s in sums.groupBy("slot", "limb").agg(F.sum("s").alias("s")).collect():
        totals[slot] += s << LIMB * limb
    return totals


def floor_mean(totals: list[int], count: int) -> list[int]:
    return [t // count for t in totals]


def matrix_of(rows: list[list[int]]) -> np.ndarray:
    """Rows of Python integers as a matrix, 64-bit where they fit."""
    values = [x for row in rows for x in row]
    small = all(-(1 << 62) < x < 1 << 62 for x in values)
    return np.array(values, np.int64 if small else object).reshape(len(rows), -1)


def doubles(m: np.ndarray) -> np.ndarray:
    """As doubles; beyond their range infinite, which no bound rules out."""
    if m.dtype != object:
        return m.astype(float)
    top = int(np.finfo(float).max)
    flat = [float(x) if -top <= x <= top else float("inf") * (1 if x > 0 else -1) for x in m.ravel().tolist()]
    return np.array(flat, float).reshape(m.shape)
