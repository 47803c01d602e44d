"""Exact top-k by integer inner product with an M-tree per shard.

Largest inner product becomes nearest neighbour in a metric space by one more component that gives all vectors
of a shard the length R of the longest: then distance² = |q|² + R² - 2 q·x. The tree is stored as flat pages.
An entry has its object, the distance to the page's parent object, and, in inner pages, a covering radius and
a child page. Search takes pages by their smallest possible distance; inside a page the stored parent distances
rule out entries by the triangle inequality before anything is computed. Bounds are used with a margin far
below the step between two integer scores, so results are exact.

That holds for vectors of a squared length below `LARGEST`. Longer ones are not in the tree: they, and all
vectors for a longer query, are ruled out by bounds of their rounded products, and what is left is multiplied in
Python integers.
"""

from __future__ import annotations

from heapq import heappop, heappush, heapreplace

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lonja.llm.common import table
from lonja.llm.vector_shards import NO_ID, smallest_ids, top_k, vectors_of

PAGE, MARGIN = 64, 1e-6
LARGEST = float(1 << 46)  # squared length up to which distances are exact well within MARGIN
FIELDS = "page_starts binary, objects binary, to_parent binary, radii binary, children binary"


def squares(v: np.ndarray) -> np.ndarray:
    """Squared lengths; infinite where they pass the range of doubles."""
    with np.errstate(over="ignore"):
        return (v * v).sum(axis=1)


def exact_best(query: np.ndarray, v: np.ndarray, at: np.ndarray, k: int) -> list[tuple[int, int]]:
    """(entry, inner product in Python integers) of the rows `at` of `v` that can be among the k + 1 largest.

    One more than k, since an entry may stand for the query alone. A rounded product is off by less than its
    bound; where it can't be told, the row is taken.
    """
    if not len(at):
        return []
    with np.errstate(over="ignore", invalid="ignore"):
        score = v[at] @ query
        off = (np.abs(v[at]) @ np.abs(query)) * ((len(query) + 2) * 2.0**-52)
        least, most = score - off, score + off
    if len(at) > k + 1:
        floor = np.partition(np.nan_to_num(least, nan=-np.inf), -(k + 1))[-(k + 1)]
        at = at[~(most < floor)]
    whole = [int(x) for x in query.tolist()]
    return [(i, sum(int(a) * b for a, b in zip(v[i].tolist(), whole, strict=True))) for i in at.tolist()]


def lifted(v: np.ndarray) -> np.ndarray:
    """Vectors with the component that makes all as long as the longest."""
    square = (v * v).sum(axis=1)
    return np.column_stack([v, np.sqrt(square.max() - square)])


def build_tree(v: np.ndarray, shard: int) -> dict[str, bytes]:
    """Pages over the rows of `v` below LARGEST, page 0 being the root; pivots are drawn by the shard's number.

    A page's parent object is the pivot whose cell it holds; the root has none.
    """
    rows = np.flatnonzero(squares(v) < LARGEST)
    if not len(rows):
        return dict.fromkeys(("page_starts", "objects", "to_parent", "radii", "children"), b"")
    rng, x = np.random.default_rng(shard), lifted(v[rows])
    pages: list[list[tuple[int, float, float, int]]] = []

    def page(members: np.ndarray, parent: int) -> int:
        number = len(pages)
        pages.append([])

        def to_parent(objects: np.ndarray) -> np.ndarray:
            return np.sqrt(((x[objects] - x[parent]) ** 2).sum(axis=1)) if parent >= 0 else np.zeros(len(objects))

        if len(members) <= PAGE:
            pages[number] = [(int(m), d, 0.0, -1) for m, d in zip(members, to_parent(members).tolist(), strict=True)]
            return number
        cells = min(PAGE, -(-2 * len(members) // PAGE))
        pivots = rng.choice(members, max(2, cells), replace=False)
        apart = np.sqrt(((x[members][:, None, :] - x[pivots][None, :, :]) ** 2).sum(axis=2))
        cell, far = apart.argmin(axis=1), to_parent(pivots)
        cell[np.searchsorted(members, pivots)] = np.arange(len(pivots))
        for c, pivot in enumerate(pivots.tolist()):
            mine = cell == c
            radius = float(apart[mine, c].max())
            pages[number].append((pivot, float(far[c]), radius, page(members[mine], pivot)))
        return number

    page(np.arange(len(x)), -1)
    starts = np.cumsum([0] + [len(p) for p in pages])
    objects, near, radii, children = zip(*[e for p in pages for e in p], strict=True)
    return {
        "page_starts": starts.astype(np.int64).tobytes(),
        "objects": rows[np.array(objects, np.int64)].tobytes(),
        "to_parent": np.array(near).tobytes(),
        "radii": np.array(radii).tobytes(),
        "children": np.array(children, np.int64).tobytes(),
    }


def search_tree(row: dict, ids: np.ndarray, ends: np.ndarray, v: np.ndarray, k: int):
    """A function from a query to its k best (vec_id, inner product) in this shard."""
    starts = np.frombuffer(row["page_starts"], np.int64).tolist()
    objects, children = (np.frombuffer(row[c], np.int64) for c in ("objects", "children"))
    near, radii = (np.frombuffer(row[c]) for c in ("to_parent", "radii"))
    square = squares(v)
    large, every = np.flatnonzero(square >= LARGEST), np.arange(len(v))
    longest = square[square < LARGEST].max(initial=0.0)
    entries = v[objects]

    def find(query: np.ndarray, query_id: int) -> list[tuple[int, int]]:
        own = float(squares(query[None, :])[0])
        whole = own + longest
        best: list[tuple[int, int]] = []  # (score, -id), the worst first

        def offer(entry: int, score: int) -> None:
            for other in smallest_ids(entry, ids, ends, k, query_id):
                found = (score, -other)
                if len(best) < k:
                    heappush(best, found)
                elif found > best[0]:
                    heapreplace(best, found)

        def distance_of_worst() -> float:
            return float(np.sqrt(max(whole - 2 * best[0][0], 0))) if len(best) == k else np.inf

        for i, score in exact_best(query, v, every if own >= LARGEST else large, k):
            offer(i, score)
        limit = distance_of_worst()
        in_tree = own < LARGEST and len(objects) > 0
        todo = [(0.0, 0, -1.0)] if in_tree else []  # smallest distance possible, page, distance to its parent
        while todo:
            bound, number, to_query = heappop(todo)
            if bound > limit + MARGIN:
                break
            lo, hi = starts[number], starts[number + 1]
            at = np.arange(lo, hi)
            if to_query >= 0 and limit < np.inf:
                at = at[np.abs(to_query - near[lo:hi]) - radii[lo:hi] <= limit + MARGIN]
            if not len(at):
                continue
            score = entries[at] @ query  # whole numbers below 2**53, so exact
            apart = np.sqrt(np.maximum(whole - 2 * score, 0))
            if children[lo] >= 0:
                least = np.maximum(apart - radii[at], 0)
                for b, child, d in zip(least.tolist(), children[at].tolist(), apart.tolist(), strict=True):
                    if b <= limit + MARGIN:
                        heappush(todo, (b, child, d))
                continue
            for i in np.flatnonzero(apart <= limit + MARGIN).tolist():
                offer(int(objects[at[i]]), int(score[i]))
            limit = distance_of_worst()
        return [(-i, s) for s, i in sorted(best, reverse=True)]

    def many(queries: np.ndarray, query_ids: list[int]) -> list[list[tuple[int, int]]]:
        """As `find` for every query of a block, which go through the tree together."""
        own = squares(queries)
        plain = np.flatnonzero(own < LARGEST) if not len(large) and len(objects) else np.zeros(0, int)
        out: list = [None] * len(queries)
        for i, best in zip(plain.tolist(), together(queries[plain], own[plain] + longest), strict=True):
            offers = [(-int(s), x) for s, e in best for x in smallest_ids(e, ids, ends, k, query_ids[i])]
            out[i] = [(x, -s) for s, x in sorted(offers)[:k]]
        for i, found in enumerate(out):
            if found is None:
                out[i] = find(queries[i], query_ids[i])
        return out

    def together(queries: np.ndarray, whole: np.ndarray) -> list[list[tuple[float, int]]]:
        """The k + 1 best (score, entry) of each query, ties to the entry with the smaller first id.

        One entry more than asked for, since one may stand for the query alone. Pages are taken by the smallest
        distance that any query of the block can find there, by those queries only that can still gain; inside a
        page each pair of query and entry is ruled out by the stored parent distances, and what is left is one
        product of matrices.
        """
        n, first_id = len(queries), ids[np.append(0, ends[:-1])]
        score, entry = np.full((n, k + 1), -np.inf), np.full((n, k + 1), -1)
        limit = np.full(n, np.inf)
        todo = [(0.0, 0, np.zeros(n), None)] if n else []
        while todo:
            least, number, bound, to_query = heappop(todo)
            if least > limit.max() + MARGIN:
                break
            lo, hi = starts[number], starts[number + 1]
            who = np.flatnonzero(bound <= limit + MARGIN)
            open_ = np.ones((len(who), hi - lo), bool)
            if to_query is not None:
                open_ = np.abs(to_query[who, None] - near[None, lo:hi]) - radii[None, lo:hi] <= limit[who, None] + MARGIN
            at = np.flatnonzero(open_.any(axis=0))
            some = open_.any(axis=1)
            who, open_ = who[some], open_[some][:, at]
            if not len(at):
                continue
            found = queries[who] @ entries[lo + at].T  # whole numbers below 2**53, so exact
            apart = np.sqrt(np.maximum(whole[who, None] - 2 * found, 0))
            if children[lo] >= 0:
                for j, e in enumerate((lo + at).tolist()):
                    reach = np.where(open_[:, j], np.maximum(apart[:, j] - radii[e], 0), np.inf)
                    reach[reach > limit[who] + MARGIN] = np.inf
                    if np.isfinite(reach).any():
                        child_bound, child_apart = np.full(n, np.inf), np.zeros(n)
                        child_bound[who], child_apart[who] = reach, apart[:, j]
                        heappush(todo, (float(reach.min()), int(children[e]), child_bound, child_apart))
                continue
            found[~open_] = -np.inf
            gain = (found >= score[who, -1:]).any(axis=1)
            who, found = who[gain], found[gain]
            all_scores = np.concatenate([score[who], found], axis=1)
            all_entries = np.concatenate([entry[who], np.broadcast_to(objects[lo + at], found.shape)], axis=1)
            order = np.lexsort((np.where(all_entries < 0, NO_ID, first_id[all_entries]), -all_scores), axis=1)[:, : k + 1]
            score[who], entry[who] = (np.take_along_axis(x, order, axis=1) for x in (all_scores, all_entries))
            worst = score[who, -1]
            limit[who] = np.where(np.isfinite(worst), np.sqrt(np.maximum(whole[who] - 2 * worst, 0)), np.inf)
        rows = zip(score.tolist(), entry.tolist(), strict=True)
        return [[(s, e) for s, e in zip(*row, strict=True) if e >= 0 and s > -np.inf] for row in rows]

    find.many = many
    return find


def largest_products(
    table: DataFrame, is_query, *, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 256, k: int = 5, **sizes
):
    """Each query's k largest inner products of floor(scale * x), exactly (see `top_k`).

    Null vectors and those with null or non-finite components take no part. A score among a shard's best that
    is no 64-bit integer fails the query, as such products do in SQL.
    """
    rows = vectors_of(table, id_col, vector_col)
    # from 2**53 on doubles are whole numbers, and floor() would cut them to longs
    floor = lambda x: F.when(F.abs(x * scale) < 2.0**53, F.floor(x * scale).cast("double")).otherwise(x * scale)
    rows = rows.withColumn("v", F.transform("v", floor))
    return top_k(rows, is_query, build_tree, FIELDS, search_tree, score="long", k=k, **sizes)


def op7_mtree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 largest integer inner products of every 50th vec_id with all embeddings."""
    return largest_products(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


OP7_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
WHERE rank <= 5"""
