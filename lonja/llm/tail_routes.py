"""Deals token sequences into shards by content, so that a shard's index holds the likely neighbours of its documents.

A sequence is sketched: its ids' inverse document frequencies are added up, with a fixed random sign, in `CELLS`
fixed random cells, and the vector is brought to length 1; products of sketches are near the cosines of the whole
vectors. A tree of two-way splits is fitted on the sketches of at most `FIT_ROWS` rows, those with the smallest
deals; the fullest leaf is split next, until there are `LEAVES_PER_SHARD` per shard. Every row goes down the tree. Leaves
beside each other share a shard as long as they fit, and a leaf beyond a shard's size is cut into as many shards by
the rows' deals, so that any number of copies leaves shards bounded. The driver holds the sample and a size per leaf.
The sample has FIT_ROWS / LEAST_LEAF leaves at most; a corpus of more shards than that (some 3,000) has leaves of
several shards, each with its part of a leaf's documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import ceil

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CELLS, FIT_ROWS, LEAST_LEAF = 512, 24_000, 8
LEAVES_PER_SHARD = 4
SLICE_ROWS = 512
TURNS = 8


def flat(tails: pa.Array, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all rows in a row, and how many each has."""
    size = pc.binary_length(tails).to_numpy(zero_copy_only=False).astype(np.int64) // np.dtype(kind).itemsize
    return np.frombuffer(b"".join(tails.to_pylist()), kind), size


@dataclass
class Sketch:
    """What an id adds to a sketch: the cell and the signed weight."""

    cell: np.ndarray
    weight: np.ndarray

    @staticmethod
    def of(idf: np.ndarray) -> Sketch:
        rng = np.random.default_rng(len(idf))
        cell, sign = rng.integers(0, CELLS, len(idf)), rng.integers(0, 2, len(idf)) * 2 - 1
        return Sketch(cell, sign * idf)

    def apply(self, tails: pa.Array, kind: str) -> np.ndarray:
        """One row per tail; an empty one is all zero."""
        out = np.zeros((len(tails), CELLS), np.float32)
        for lo in range(0, len(tails), SLICE_ROWS):
            ids, n = flat(tails.slice(lo, SLICE_ROWS), kind)
            at = np.repeat(np.arange(len(n)) * CELLS, n) + self.cell[ids]
            x = np.bincount(at, self.weight[ids], len(n) * CELLS).reshape(len(n), CELLS)
            out[lo : lo + SLICE_ROWS] = x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)
        return out


def halves(x: np.ndarray) -> tuple[np.ndarray, float] | None:
    """A direction and a cut that part the rows in two: 2-means, started at the median of the main direction.

    `x` may be in half precision; one copy of it in single precision is held at a time, the driver has little room.
    """
    centred = x.astype(np.float32)
    centred -= centred.mean(0)
    far = [(centred[lo : lo + SLICE_ROWS] ** 2).sum(1) for lo in range(0, len(centred), SLICE_ROWS)]
    way = centred[np.argmax(np.concatenate(far))]
    for _ in range(TURNS):
        way = centred.T @ (centred @ way)
        way /= max(np.linalg.norm(way), 1e-12)
    along = centred @ way
    del centred
    side = along > np.median(along)
    x = x.astype(np.float32, copy=False)
    found = None
    for _ in range(TURNS):
        if side.all() or not side.any():
            break
        a, b = x[~side].mean(0), x[side].mean(0)
        found = (b - a, float((b @ b - a @ a) / 2))
        side = x @ found[0] > found[1]
    return found if found and side.any() and not side.all() else None


@dataclass
class Tree:
    """Splits as rows of `way` and `cut`; `below` has the children, a leaf's number k as -1 - k."""

    way: np.ndarray
    cut: np.ndarray
    below: np.ndarray
    leaves: int

    @staticmethod
    def fit(x: np.ndarray, leaves: int) -> Tree:
        way, cut, below, fixed = [], [], [], []
        open_leaves = [(np.arange(len(x)), None)]  # (rows, the place in `below` that leads here)
        while open_leaves and len(open_leaves) + len(fixed) < leaves:
            at = max(range(len(open_leaves)), key=lambda i: len(open_leaves[i][0]))
            rows, place = open_leaves.pop(at)
            split = halves(x[rows]) if len(rows) >= 2 * LEAST_LEAF else None
            if split is None:
                fixed.append(place)
                continue
            node = len(way)
            if place is not None:
                below[place[0]][place[1]] = node
            way.append(split[0])
            cut.append(split[1])
            below.append([0, 0])
            right = x[rows].astype(np.float32, copy=False) @ split[0] > split[1]
            open_leaves += [(rows[~right], (node, 0)), (rows[right], (node, 1))]
        leaf, todo = 0, [(0, 1), (0, 0)] if way else []
        while todo:  # leaves are numbered from left to right, so neighbours are alike
            node, side = todo.pop()
            child = below[node][side]
            if child:
                todo += [(child, 1), (child, 0)]
            else:
                below[node][side] = -1 - leaf
                leaf += 1
        shape = (len(way), x.shape[1] if x.ndim == 2 else CELLS)
        return Tree(
            np.array(way, np.float32).reshape(shape), np.array(cut, np.float32), np.array(below, np.int32).reshape(-1, 2), max(1, leaf)
        )

    def leaf(self, x: np.ndarray) -> np.ndarray:
        if not len(self.way):
            return np.zeros(len(x), np.int32)
        at, going = np.zeros(len(x), np.int32), np.arange(len(x))
        while len(going):
            node = at[going]
            right = np.einsum("ij,ij->i", x[going], self.way[node]) > self.cut[node]
            at[going] = self.below[node, right.astype(int)]
            going = going[at[going] >= 0]
        return -1 - at


def shards(sizes: dict[int, float], leaves: int, most: float) -> tuple[np.ndarray, np.ndarray]:
    """The first shard of each leaf and how many it has, from the leaves' sizes."""
    first, count = np.zeros(leaves, np.int64), np.ones(leaves, np.int64)
    shard, held = 0, 0.0
    for k in range(leaves):
        size = sizes.get(k, 0.0)
        if held and held + size > most:
            shard, held = shard + 1, 0.0
        first[k], count[k] = shard, max(1, ceil(size / most))
        held += size
        if count[k] > 1:
            shard, held = shard + int(count[k]), 0.0
    return first, count


def fit(tokens: DataFrame, sketch: Sketch, kind: str, rows: int, shards: int) -> Tree:
    """The tree for `tokens` (tail, deal), of which there are `rows`, in about so many shards."""
    share = min(1.0, 1.2 * FIT_ROWS / max(1, rows))
    near = tokens.where(F.col("deal") < F.lit(int(-(1 << 63) + share * ((1 << 64) - 2048))))
    near = near.where(F.length("tail") > 0).orderBy("deal").limit(FIT_ROWS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = sketch.apply(batch.column("tail"), kind)
            out = pa.array([r.tobytes() for r in x.astype(np.float16)], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("deal"), out], ["deal", "x"])

    if shards < 2:
        return Tree.fit(np.zeros((0, CELLS), np.float32), 1)
    found = near.select("deal", "tail").mapInArrow(run, "deal long, x binary").toArrow().sort_by("deal").column("x")
    x = np.empty((len(found), CELLS), np.float16)
    at = 0
    for chunk in found.chunks:
        for lo in range(0, len(chunk), SLICE_ROWS):
            some = b"".join(chunk.slice(lo, SLICE_ROWS).to_pylist())
            x[at : at + SLICE_ROWS] = np.frombuffer(some, np.float16).reshape(-1, CELLS)
            at += len(chunk.slice(lo, SLICE_ROWS))
    del found
    pa.default_memory_pool().release_unused()
    return Tree.fit(x, LEAVES_PER_SHARD * shards)


def with_leaf(tokens: DataFrame, sketch: Sketch, tree: Tree, kind: str) -> DataFrame:
    """`tokens` (tail and any other columns) with the leaf of every row."""
    shared = tokens.sparkSession.sparkContext.broadcast((sketch, tree))  # vocabulary, and FIT_ROWS / LEAST_LEAF leaves

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch, tree = shared.value
        for batch in batches:
            leaf = tree.leaf(sketch.apply(batch.column("tail"), kind))
            yield batch.append_column("leaf", pa.array(leaf, pa.int32()))

    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in tokens.schema)
    return tokens.mapInArrow(run, f"{kept}, leaf int")


def with_shard(tokens: DataFrame, first: np.ndarray, count: np.ndarray) -> DataFrame:
    """The shard of every row, by its leaf and, in leaves of several shards, by its deal."""
    spark = tokens.sparkSession
    names = "leaf int, first long, many long"
    found = spark.createDataFrame([(k, int(f), int(c)) for k, (f, c) in enumerate(zip(first, count, strict=True))], names)
    dealt = tokens.join(F.broadcast(found), "leaf")  # at most FIT_ROWS / LEAST_LEAF rows
    return dealt.withColumn("shard", (F.col("first") + F.pmod("deal", "many")).cast("int")).drop("leaf", "first", "many")
