"""Searching a sharded index of vectors: valid rows, index rows, query blocks and the merge of shard results.

Rows are dealt by hash into shards of about `shard_rows`, each of which becomes one index row of flat arrays.
Queries are packed into blocks. Every pair of a shard and a block is one group of a cogroup, so the memory of a
task is bounded by one shard and one block, and the shuffle moves whole shards, not rows. Equal vectors of a
shard are one entry with a list of ids, so a vector that a third of all rows share costs one entry per shard.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lonja.llm.common import grouped, ship, written

NO_ID = (1 << 63) - 1
SHARD_ROWS, BLOCK_QUERIES = 4096, 512
RESULT = "number long, query_id long, vec_id long, score {}"


def finite(vector: Column) -> Column:
    """Whether a vector is there, not empty, and without null, NaN or infinite components."""
    good = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(vector.isNotNull() & (F.size(vector) > 0) & good, F.lit(False))


def vectors_of(table: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, v as doubles, dim) of the rows that take part."""
    v = F.col(vector_col).cast("array<double>")
    rows = table.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v")).where(finite(F.col("v")))
    return rows.withColumn("dim", F.size("v"))


def matrix(column: pa.ChunkedArray, dim: int) -> np.ndarray:
    flat = column.combine_chunks().flatten()
    return flat.to_numpy(zero_copy_only=False).reshape(-1, dim)


def distinct_vectors(ids: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids sorted inside each distinct vector, where each vector's ids end, and the vectors."""
    v = np.ascontiguousarray(v + 0.0)  # -0.0 as 0.0
    _, first, code = np.unique(v.view(f"V{v.itemsize * v.shape[1]}").ravel(), return_index=True, return_inverse=True)
    order = np.lexsort((ids, code))
    return ids[order], np.cumsum(np.bincount(code)), v[first]


def smallest_ids(entry: int, ids: np.ndarray, ends: np.ndarray, k: int, but: int) -> list[int]:
    """The k smallest ids of an entry other than the query's."""
    mine = ids[ends[entry - 1] if entry else 0 : ends[entry]]
    lo, hi = np.searchsorted(mine, but, "left"), np.searchsorted(mine, but, "right")
    head = mine[: min(k, lo)]
    return head.tolist() + mine[hi : hi + k - len(head)].tolist()


def build_index(rows: DataFrame, build: Callable, fields: str, shards: int) -> DataFrame:
    """One row per shard: dim, shard, ids, id_ends, vectors (64-bit), and what `build(vectors, shard)` returns."""
    schema = f"dim int, shard int, ids binary, id_ends binary, vectors binary, {fields}"
    kinds = [(f.split()[0], f.split()[1]) for f in fields.split(", ")]
    arrow = {"binary": pa.binary(), "array<binary>": pa.list_(pa.binary())}

    def work(group: pa.Table) -> Iterator[pa.RecordBatch]:
        dim, shard = (group.column(c)[0].as_py() for c in ("dim", "shard"))
        given = group.column("vec_id").fill_null(NO_ID).to_numpy()
        ids, ends, v = distinct_vectors(given, matrix(group.column("v"), dim))
        found = build(v, shard)
        cols = [pa.array([dim], pa.int32()), pa.array([shard], pa.int32())]
        cols += [pa.array([x.tobytes()], pa.binary()) for x in (ids, ends, v)]
        cols += [pa.array([found[n]], arrow[k]) for n, k in kinds]
        yield pa.RecordBatch.from_arrays(cols, ["dim", "shard", "ids", "id_ends", "vectors", *found])

    shard = F.pmod(F.xxhash64("vec_id", "v"), F.lit(shards)).cast("int")
    return grouped(rows.withColumn("shard", shard), ["dim", "shard"], work, schema)


def query_blocks(queries: DataFrame, blocks: int) -> DataFrame:
    """Rows (dim, block, numbers, ids, vectors) of numbered queries."""

    def work(group: pa.Table) -> Iterator[pa.RecordBatch]:
        dim, block = (group.column(c)[0].as_py() for c in ("dim", "block"))
        parts = [group.column("number").to_numpy(), group.column("vec_id").to_numpy(), matrix(group.column("v"), dim)]
        cols = [pa.array([dim], pa.int32()), pa.array([block], pa.int32())]
        cols += [pa.array([np.ascontiguousarray(x).tobytes()], pa.binary()) for x in parts]
        yield pa.RecordBatch.from_arrays(cols, ["dim", "block", "numbers", "query_ids", "queries"])

    rows = queries.withColumn("block", F.pmod(F.xxhash64("number"), F.lit(blocks)).cast("int"))
    schema = "dim int, block int, numbers binary, query_ids binary, queries binary"
    return grouped(rows, ["dim", "block"], work, schema)


def search_index(index: DataFrame, blocks: DataFrame, search: Callable, k: int, score: str, counts: tuple[int, int]):
    """The k best rows of every query in every shard. `search(row, ids, ends, vectors, k)` gives a function from a
    query and its id to (vec_id, score) pairs, which may have `many` for a whole block; `row` holds the index row's
    own fields."""
    kind = {"double": pa.float64(), "long": pa.int64()}[score]
    names = ["number", "query_id", "vec_id", "score"]

    def work(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        for at, row in enumerate(left.drop(["block"]).to_pylist() if right.num_rows else []):
            ids, ends = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["id_ends"], np.int64)
            v = np.frombuffer(row["vectors"]).reshape(len(ends), -1)
            find = search(row, ids, ends, v, k)
            for block in right.to_pylist():
                number, query_id = (np.frombuffer(block[c], np.int64).tolist() for c in ("numbers", "query_ids"))
                queries = np.frombuffer(block["queries"]).reshape(len(number), -1)
                many = getattr(find, "many", None) or (lambda x, q: [find(*one) for one in zip(x, q, strict=True)])
                for n, q, best in zip(number, query_id, many(queries, query_id), strict=True):
                    out += [(n, q, None if i == NO_ID else i, s) for i, s in best]
        cols = list(zip(*out, strict=True)) or [()] * 4
        types = [pa.int64()] * 3 + [kind]
        return pa.table([pa.array(list(c), t) for c, t in zip(cols, types, strict=True)], names)

    shards, n = counts
    left = index.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
    right = blocks.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    keys = ["dim", "shard", "block"]
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(work, RESULT.format(score))


def top_k(
    rows: DataFrame,
    is_query: Column,
    build: Callable,
    fields: str,
    search: Callable,
    *,
    score: str,
    k: int = 5,
    shard_rows: int = SHARD_ROWS,
    block_queries: int = BLOCK_QUERIES,
) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k best rows, best first, ties to the smaller vec_id.

    `rows` are those of `vectors_of`. A row is a candidate of every query with another vec_id and as many
    components; a null vec_id is a candidate only, after all others on ties. A repeated row is several
    candidates and one query. Without rows or queries there is no result.
    """
    spark = rows.sparkSession
    ship(spark)
    queries = rows.where(is_query).dropDuplicates(["vec_id", "v"])
    queries = written(queries.withColumn("number", F.monotonically_increasing_id()), "vector-queries")
    shards, blocks = ceil(rows.count() / shard_rows), ceil(queries.count() / block_queries)
    if not shards or not blocks:
        return spark.createDataFrame([], f"query_id long, rank int, vec_id long, score {score}")
    index = written(build_index(rows, build, fields, shards), "vector-index")
    found = search_index(index, query_blocks(queries, blocks), search, k, score, (shards, blocks))
    best = Window.partitionBy("number").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last())
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
