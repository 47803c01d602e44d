"""Approximate nearest neighbours by cosine: one hierarchical navigable small-world graph per shard.

A graph is stored as flat arrays: per level the nodes and a matrix of neighbour numbers (-1: none). A shard is
small enough to hold the distances between all its nodes while the graph is built, so the candidates of a new
node are the exact nearest among those inserted before, instead of the outcome of a search.
"""

from __future__ import annotations

from heapq import heappop, heappush, heapreplace
from math import log

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lonja.llm.common import table
from lonja.llm.vector_shards import smallest_ids, top_k, vectors_of

LINKS, BUILD_WIDTH, SEARCH_WIDTH = 16, 64, 128
FIELDS = "level_nodes array<binary>, level_links array<binary>"


def unit(v: np.ndarray) -> np.ndarray:
    scale = np.abs(v).max(axis=-1, keepdims=True)
    v = v / scale
    return (v / np.linalg.norm(v, axis=-1, keepdims=True)).astype(np.float32)


def diverse(near: np.ndarray, far: np.ndarray, between: np.ndarray, most: int) -> list[int]:
    """Positions of up to `most` candidates, nearest first, each nearer to the node than to any chosen one;
    free places go to the nearest of the others. `far`: distances to the node, `between`: among candidates."""
    chosen: list[int] = []
    blocked = np.zeros(len(near), bool)
    for i in range(len(near)):
        if not blocked[i]:
            chosen.append(i)
            if len(chosen) == most:
                return chosen
            blocked |= between[i] < far
    for i in np.flatnonzero(blocked).tolist():
        if len(chosen) == most:
            break
        if i not in chosen:
            chosen.append(i)
    return chosen


def build_graph(v: np.ndarray, shard: int) -> dict[str, list[bytes]]:
    """Levels of a graph over the rows of `v`; node 0 .. n-1 in a shuffled order, levels drawn by the shard."""
    rng, x = np.random.default_rng(shard), unit(v)
    apart = 1 - x @ x.T
    order = rng.permutation(len(x))
    height = np.floor(-np.log(1 - rng.random(len(x))) / log(LINKS)).astype(int)
    height[order[0]] = height.max()
    nodes, links = [], []
    for level in range(height.max() + 1):
        members = order[height[order] >= level]
        most = LINKS if level else 2 * LINKS
        place = np.full(len(x), -1)
        place[members] = np.arange(len(members))
        lists: list[list[int]] = [[] for _ in members]
        for i, node in enumerate(members.tolist()):
            if not i:
                continue
            d = apart[node, members[:i]]
            near = np.argpartition(d, BUILD_WIDTH)[:BUILD_WIDTH] if i > BUILD_WIDTH else np.arange(i)
            near = members[near[np.argsort(d[near], kind="stable")]]
            picked = near[diverse(near, apart[node, near], apart[np.ix_(near, near)], LINKS)]
            lists[i] = picked.tolist()
            for other in lists[i]:
                theirs = lists[place[other]]
                theirs.append(node)
                if len(theirs) > most:
                    old = np.array(theirs)
                    old = old[np.argsort(apart[other, old], kind="stable")]
                    keep = diverse(old, apart[other, old], apart[np.ix_(old, old)], most)
                    lists[place[other]] = old[keep].tolist()
        flat = np.full((len(members), most), -1, np.int32)
        for i, mine in enumerate(lists):
            flat[i, : len(mine)] = mine
        nodes.append(members.astype(np.int32).tobytes())
        links.append(flat.tobytes())
    return {"level_nodes": nodes, "level_links": links}


def search_graph(row: dict, ids: np.ndarray, ends: np.ndarray, v: np.ndarray, k: int):
    """A function from a query to its k nearest (vec_id, cosine) in this shard."""
    x = unit(v)
    levels = []
    for members, flat in zip(row["level_nodes"], row["level_links"], strict=True):
        members = np.frombuffer(members, np.int32)
        flat = np.frombuffer(flat, np.int32).reshape(len(members), -1)
        of: list = [None] * len(x)
        for node, mine in zip(members.tolist(), flat, strict=True):
            of[node] = mine[mine >= 0]
        levels.append(of)
    entry = int(np.frombuffer(row["level_nodes"][-1], np.int32)[0])
    width = max(SEARCH_WIDTH, 4 * k)
    norms = np.sqrt((v * v).sum(axis=1))

    def find(query: np.ndarray, query_id: int) -> list[tuple[int, float]]:
        q = unit(query)
        at, here = entry, float(x[entry] @ q)
        for of in levels[:0:-1]:
            while len(of[at]):
                s = x[of[at]] @ q
                best = int(s.argmax())
                if s[best] <= here:
                    break
                at, here = int(of[at][best]), float(s[best])
        seen = np.zeros(len(x), bool)
        seen[at] = True
        todo, best = [(-here, at)], [(here, at)]
        of = levels[0]
        while todo:
            far, node = heappop(todo)
            if -far < best[0][0] and len(best) >= width:
                break
            new = of[node][~seen[of[node]]]
            if not len(new):
                continue
            seen[new] = True
            for s, other in zip((x[new] @ q).tolist(), new.tolist(), strict=True):
                if len(best) < width:
                    heappush(best, (s, other))
                elif s > best[0][0]:
                    heapreplace(best, (s, other))
                else:
                    continue
                heappush(todo, (-s, other))
        nodes = np.array([n for _, n in best])
        # the exact measure, summed in the same order for every row
        exact = (v[nodes] * query).sum(axis=1) / (norms[nodes] * np.sqrt((query * query).sum()))
        found = [
            (-s, i) for s, n in zip(exact.tolist(), nodes.tolist(), strict=True) for i in smallest_ids(n, ids, ends, k, query_id)
        ]
        return [(i, -s) for s, i in sorted(found)[:k]]

    return find


def nearest(table: DataFrame, is_query, *, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 5, **sizes):
    """Each query's k nearest found by cosine; null, zero and non-finite vectors take no part (see `top_k`)."""
    rows = vectors_of(table, id_col, vector_col).where(F.exists("v", lambda x: x != 0))
    return top_k(rows, is_query, build_graph, FIELDS, search_graph, score="double", k=k, **sizes)


def op6_hnsw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 nearest of every 50th vec_id among all embeddings."""
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)
