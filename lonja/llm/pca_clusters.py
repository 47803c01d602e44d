"""Integer k-means with a filter in PCA-rotated coordinates.

The rotation comes from the vectors' second moments, which the tasks add up. Every vector is stored once with its
`LEADING` first rotated coordinates and the length of what they leave. For a centroid rotated alike, the squared
distance of the leading coordinates plus the squared difference of the two residual lengths is a lower bound of
the squared distance: the rotation keeps lengths, and residuals are at least as far apart as their lengths. In
every round a vector's distance to the centroid with the least bound is computed in integers, and of the others only
those whose bound, less a margin for rounding, doesn't exceed it. Which centroid is nearest, ties included, is
decided by integers alone, so the rotation changes the work and never the result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lonja.llm.common import discard, ship, table, written
from lonja.llm.whole_vectors import (
    SUMS,
    Sums,
    by_length,
    collected,
    column_sums,
    doubles,
    fitting,
    floor_mean,
    matrix_of,
    squared,
    usable,
    whole,
)

DIM, CLUSTERS, ROUNDS, SCALE, LEADING = 64, 8, 10, 1024, 8
MARGIN = 1e-9
SUM_COLUMNS = [c.split()[0] for c in SUMS.split(", ")]


class Rotation:
    """The mean and the directions of largest spread, largest first."""

    def __init__(self, mean: np.ndarray, basis: np.ndarray):
        self.mean, self.basis = mean, basis

    def apply(self, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Leading coordinates of each row and the length of its residual."""
        with np.errstate(all="ignore"):
            x = v - self.mean
            lead = x @ self.basis
            return lead, np.sqrt(((x - lead @ self.basis.T) ** 2).sum(axis=1))


def fit_rotation(rows: DataFrame, dim: int, leading: int, scale: int) -> Rotation:
    """From the count, the sum and the products of scaled components over all rows, added up on Spark.

    Where these pass the range of doubles, the leading coordinates are the first components.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 + dim + dim * dim)
        with np.errstate(all="ignore"):
            for batch in batches:
                for _, _, x in by_length(batch.column("v")):
                    v = doubles(whole(x, scale))
                    total += np.concatenate([[len(v)], v.sum(axis=0), (v.T @ v).ravel()])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], ["slot", "s"])

    found = rows.select("v").mapInArrow(run, "slot long, s double").groupBy("slot").agg(F.sum("s").alias("s"))
    total = np.array([s for _, s in sorted(found.collect())])
    n, mean = total[0], total[1 : dim + 1] / total[0]
    with np.errstate(all="ignore"):
        spread = total[dim + 1 :].reshape(dim, dim) / n - np.outer(mean, mean)
    if not np.isfinite(spread).all():
        return Rotation(np.zeros(dim), np.eye(dim)[:, :leading])
    _, directions = np.linalg.eigh((spread + spread.T) / 2)
    return Rotation(mean, np.ascontiguousarray(directions[:, ::-1][:, :leading]))


class Centroids:
    """Centroids in integers and in rotated coordinates."""

    def __init__(self, entries: np.ndarray, rotation: Rotation):
        self.entries = entries
        self.lead, self.rest = rotation.apply(doubles(entries))

    def bounds(self, lead: np.ndarray, rest: np.ndarray) -> np.ndarray:
        """Lower bounds of the squared distances, less what rounding can add; not a number where they can't be told."""
        with np.errstate(all="ignore"):
            near = ((lead[:, None, :] - self.lead[None, :, :]) ** 2).sum(axis=2)
            near += (rest[:, None] - self.rest[None, :]) ** 2
            mine, other = (lead**2).sum(axis=1) + rest**2, (self.lead**2).sum(axis=1) + self.rest**2
            return near - MARGIN * (mine[:, None] + other[None, :])

    def nearest(self, v: np.ndarray, lead: np.ndarray, rest: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """Number of the nearest centroid and its squared distance per row, and how many distances were computed."""
        v, entries = fitting(v, self.entries)
        bounds = self.bounds(lead, rest)
        if v.dtype == object:  # too large for doubles to tell distances apart
            bounds[:] = np.nan
        first = np.nan_to_num(bounds, nan=np.inf).argmin(axis=1)
        best = squared(v, entries[first])
        number, rows = first.copy(), np.arange(len(v))
        open_ = ~(bounds > doubles(best)[:, None])
        open_[rows, first] = False
        computed = len(v)
        for k in range(len(entries)):
            at = np.flatnonzero(open_[:, k])
            found = squared(v[at], entries[k])
            better = (found < best[at]) | ((found == best[at]) & (k < number[at]))
            best[at[better]], number[at[better]] = found[better], k
            computed += len(at)
        return number, best, computed


def start(rows: DataFrame, dim: int, clusters: int, salt: int, scale: int) -> np.ndarray:
    """The vectors whose `salt:<vec_id>` has the smallest SHA-256; of equal ids the smaller vector first."""
    digest = F.sha2(F.concat(F.lit(f"{salt}:"), F.col("vec_id").cast("string")), 256)
    first = rows.orderBy(digest.asc_nulls_last(), "v").limit(clusters).select("v").collect()
    return whole(np.array([r.v for r in first], float).reshape(len(first), dim), scale)


def cluster(
    vectors: DataFrame,
    *,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    dim: int = DIM,
    clusters: int = CLUSTERS,
    rounds: int = ROUNDS,
    scale: int = SCALE,
    salt: int = 3,
    leading: int = LEADING,
    progress: Callable[[int, int], None] | None = None,
) -> tuple[DataFrame, list[list[int]]]:
    """(vec_id, cluster, distance) of every usable row of `dim` components, and the final centroids.

    Null vectors, those with null or non-finite components and those of another length are left out; repeated rows
    count as often as they occur; a null vec_id stays null and starts a centroid only after all others. Fewer rows
    than clusters make fewer centroids, no rows none. A squared distance beyond 64 bits fails the query. `progress`
    gets how many rows a round had and how many distances it computed. The driver holds centroids and moments only.
    """
    spark = vectors.sparkSession
    ship(spark)
    v = F.col(vector_col).cast("array<double>")
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v"))
    rows = rows.where(usable(F.col("v")) & (F.size("v") == dim))
    entries = start(rows, dim, clusters, salt, scale)
    if not len(entries):
        return spark.createDataFrame([], "vec_id long, cluster int, distance long"), []
    rotation = fit_rotation(rows, dim, leading, scale)

    def rotated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, x in by_length(batch.column("v")):
                lead, rest = rotation.apply(doubles(whole(x, scale)))
                flat = pa.FixedSizeListArray.from_arrays(lead.ravel(), leading).cast(pa.list_(pa.float64()))
                cols = [batch.column("vec_id"), batch.column("v"), flat, pa.array(rest)]
                yield pa.RecordBatch.from_arrays(cols, ["vec_id", "v", "lead", "rest"])

    stored = rows.mapInArrow(rotated, "vec_id long, v array<double>, lead array<double>, rest double")
    stored = written(stored, "rotated-vectors")

    def assigned(batches: Iterator[pa.RecordBatch], now: Centroids):
        """(batch, integer vectors, numbers, distances, distances computed)"""
        for batch in batches:
            for _, _, x in by_length(batch.column("v")):
                ints = whole(x, scale)
                lead = batch.column("lead").flatten().to_numpy().reshape(len(x), leading)
                yield batch, ints, *now.nearest(ints, lead, batch.column("rest").to_numpy())

    n_slots = len(entries) * (dim + 1)
    for _ in range(rounds):
        now = Centroids(entries, rotation)

        def round_sums(batches: Iterator[pa.RecordBatch], now: Centroids = now) -> Iterator[pa.RecordBatch]:
            sums, computed = Sums(n_slots + 1), 0
            for _, ints, number, _, tried in assigned(batches, now):
                computed += tried
                for k in np.unique(number).tolist():
                    mine = ints[number == k]
                    sums.add(k * (dim + 1), np.append(column_sums(mine), len(mine)))
            sums.totals[n_slots] = computed
            columns = list(zip(*sums.rows(), strict=True)) or [(), (), ()]
            types = [pa.int64(), pa.int32(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], SUM_COLUMNS)

        totals = collected(stored.mapInArrow(round_sums, SUMS), n_slots + 1)
        if progress:
            progress(sum(totals[dim : n_slots : dim + 1]), totals[n_slots])
        new = []
        for k, old in enumerate(entries.tolist()):
            *sums, count = totals[k * (dim + 1) : (k + 1) * (dim + 1)]
            new.append(floor_mean(sums, count) if count else old)
        entries = matrix_of(new)
    last = Centroids(entries, rotation)

    def final(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, _, number, best, _ in assigned(batches, last):
            cols = [batch.column("vec_id"), pa.array(number.astype(np.int32)), pa.array(best.tolist(), pa.int64())]
            yield pa.RecordBatch.from_arrays(cols, ["vec_id", "cluster", "distance"])

    found = written(stored.mapInArrow(final, "vec_id long, cluster int, distance long"), "clusters")
    discard(stored)
    return found, entries.tolist()


def with_digests(found: DataFrame, centroids: list[list[int]]) -> DataFrame:
    """Adds each cluster's and the whole inertia and the digest of the cluster's centroid.

    One row per centroid is joined, so the broadcast is bounded by their number.
    """
    spark = found.sparkSession
    inertia = dict(found.groupBy("cluster").agg(F.sum("distance")).collect())
    rows = [
        (k, inertia.get(k, 0), sum(inertia.values()), hashlib.sha256(",".join(map(str, c)).encode()).hexdigest())
        for k, c in enumerate(centroids)
    ]
    schema = "cluster int, cluster_inertia long, inertia long, centroid_sha256 string"
    return found.join(F.broadcast(spark.createDataFrame(rows, schema)), "cluster")


def op12_pca_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All embeddings of 64 components in 8 clusters after 10 rounds."""
    found, centroids = cluster(table(spark, sf_dir, "embeddings"))
    columns = ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    return with_digests(found, centroids).select(*columns)


def floored(total: str, n: str) -> str:
    """SQL for the exact floor of a quotient of integers, the divisor being positive."""
    return f"CAST(({total} - (({total} % {n}) + {n}) % {n}) // {n} AS BIGINT)"


def clusters_sql(clusters: int = CLUSTERS, rounds: int = ROUNDS) -> str:
    apart = "list_sum(list_transform(list_zip(v.v, c.v), lambda p: (p[1] - p[2]) * (p[1] - p[2])))"
    steps = [
        """
v AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id,
         list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE embedding IS NOT NULL AND len(embedding) = 64
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
        "e AS MATERIALIZED (SELECT r, i, v[i] AS x FROM v, range(1, 65) AS t(i))",
        f"""
c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256(concat('3:', vec_id))) - 1 AS c, v FROM v
  ORDER BY sha256(concat('3:', vec_id)) LIMIT {clusters})""",
    ]
    for i in range(rounds + 1):
        steps.append(f"""
a{i} AS MATERIALIZED (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY r ORDER BY d, c) AS place
                 FROM (SELECT r, vec_id, c, CAST({apart} AS BIGINT) AS d FROM v CROSS JOIN c{i} AS c))
  WHERE place = 1)""")
        if i < rounds:
            steps.append(f"""
c{i + 1} AS MATERIALIZED (
  SELECT c.c, coalesce(m.v, c.v) AS v FROM c{i} AS c LEFT JOIN (
    SELECT c, list(x ORDER BY i) AS v FROM (
      SELECT c, i, {floored("sum(x)", "count(*)")} AS x FROM a{i} JOIN e USING (r) GROUP BY c, i) GROUP BY c) AS m
  USING (c))""")
    return f"""WITH {",".join(steps)}
SELECT vec_id, CAST(a.c AS INTEGER) AS cluster, d AS distance,
       CAST(sum(d) OVER (PARTITION BY a.c) AS BIGINT) AS cluster_inertia, CAST(sum(d) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(c.v, ',')) AS centroid_sha256
FROM a{rounds} AS a JOIN c{rounds} AS c ON a.c = c.c"""
