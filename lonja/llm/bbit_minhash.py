"""Near-duplicate groups by b-bit MinHash.

A document is the set of its distinct word shingles. `HASHES` minima are taken over the set; runs of `ROWS`
whole minima are the band keys, and the low `BITS` bits of each are packed into a signature. Documents that
share a band key are candidates: the share of equal signature lanes, counted by bits and corrected for the
chance that unequal minima agree in their low bits, estimates their similarity. Candidates whose estimate is
not clearly below the threshold form clusters, and inside a cluster links are confirmed on full sets.

With 32 bands of 4, a pair at similarity 0.8 shares no band with probability 5e-8; an estimate that is 5.5
standard deviations too low has a probability of 2e-8. Equal sets are one node from the start, so a text
copied a million times costs one. Buckets and clusters above a bound are treated in pairs of blocks: every pair
of members still meets, but no task holds more than two blocks. Inside a task a breadth-first search compares
each member only with those that are not yet reached, so dense groups take nearly linear time.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lonja.llm.common import grouped, ship, table, written
from lonja.llm.components import components
from lonja.llm.lempel_ziv import Runs, mix

ROWS, BANDS, BITS = 4, 32, 2
HASHES = ROWS * BANDS
DEVIATIONS = 5.5
CHUNK_WORDS = 40_000
BUCKET_BLOCK = 8192
CLUSTER_BLOCK = 4_000_000
NO_ID = -(1 << 63)

_rng = np.random.default_rng(20_240_601)
FACTORS = _rng.integers(0, 1 << 63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
OFFSETS = _rng.integers(0, 1 << 63, HASHES, dtype=np.uint64)
ODD_BITS = np.uint64(0x5555555555555555)


def words_of(text: str | None) -> list[bytes]:
    """Words of a text with A-Z in lower case; other letters stay."""
    return (text or "").encode().lower().split()


def shingle_sets(texts: list[str | None], size: int) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of each text's shingles; fewer words than `size` are one shingle."""
    words: list[bytes] = []
    bounds = [0]
    for text in texts:
        words += words_of(text)
        bounds.append(len(words))
    if not words:
        return [np.zeros(0, np.uint64) for _ in texts]
    run = Runs(words)
    hashes = run(np.arange(max(0, len(words) - size + 1)), size)
    out = []
    for lo, hi in zip(bounds[:-1], bounds[1:], strict=True):
        if hi - lo >= size:
            out.append(np.unique(hashes[lo : hi - size + 1]))
        else:
            out.append(run(np.array([lo]), hi - lo) ^ np.uint64(hi - lo) if hi > lo else np.zeros(0, np.uint64))
    return out


def minima(sets: list[np.ndarray]) -> np.ndarray:
    """One row of HASHES minima per nonempty set."""
    values = np.concatenate(sets)
    starts = np.cumsum([0] + [len(s) for s in sets[:-1]])
    out = np.empty((len(sets), HASHES), np.uint64)
    for i in range(HASHES):
        out[:, i] = np.minimum.reduceat(values * FACTORS[i] + OFFSETS[i], starts)
    return out


def band_keys(mins: np.ndarray) -> np.ndarray:
    keys = np.repeat(np.arange(1, BANDS + 1, dtype=np.uint64)[None, :], len(mins), 0)
    for r in range(ROWS):
        keys = mix(keys ^ mins[:, r::ROWS])
    return keys


def signatures(mins: np.ndarray) -> np.ndarray:
    """Low bits of the minima, packed into 64-bit words. The lowest bits of a product mix badly, so bits 24 on."""
    lanes = 64 // BITS
    low = ((mins >> np.uint64(24)) & np.uint64((1 << BITS) - 1)).reshape(len(mins), -1, lanes)
    return np.bitwise_or.reduce(low << (np.arange(lanes, dtype=np.uint64) * np.uint64(BITS)), axis=2)


def estimate(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Similarity of signatures from equal lanes, corrected for chance agreement."""
    x = a ^ b
    unequal = np.bitwise_count((x | (x >> np.uint64(1))) & ODD_BITS).sum(axis=-1)
    chance = 0.5**BITS
    return (1 - unequal / HASHES - chance) / (1 - chance)


def lenient(threshold: float) -> float:
    """The threshold less DEVIATIONS standard deviations of the estimate."""
    chance = 0.5**BITS
    p = chance + (1 - chance) * threshold
    return threshold - DEVIATIONS * (p * (1 - p) / HASHES) ** 0.5 / (1 - chance)


def reach(n: int, near: Callable[[int, np.ndarray], np.ndarray]) -> list[tuple[int, int]]:
    """Breadth-first search: (member, root) of all that are reached. `near(i, rest)` masks `rest`."""
    rest, out = np.arange(n), []
    while len(rest) > 1:
        root, rest = int(rest[0]), rest[1:]
        queue = [root]
        while queue and len(rest):
            hit = near(queue.pop(), rest)
            queue += rest[hit].tolist()
            out += [(i, root) for i in rest[hit].tolist()]
            rest = rest[~hit]
    return out


def linked_sets(sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """(member, root) by links with 100 * intersection >= percent * union."""
    size = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(len(sets)), size)
    code = np.unique(np.concatenate(sets), return_inverse=True)[1]
    order = np.argsort(code, kind="stable")
    holders, first = owner[order], np.searchsorted(code[order], np.arange(code.max() + 2))
    bounds = np.append(0, np.cumsum(size))

    def near(i: int, rest: np.ndarray) -> np.ndarray:
        mine = code[bounds[i] : bounds[i + 1]]
        lo, n = first[mine], first[mine + 1] - first[mine]
        at = np.repeat(lo - np.cumsum(n) + n, n) + np.arange(n.sum())
        both = np.bincount(holders[at], minlength=len(sets))[rest]
        return 100 * both >= percent * (size[i] + size[rest] - both)

    return reach(len(sets), near)


def sketch(docs: DataFrame, size: int) -> DataFrame:
    """(doc_id, crc, key, n, digest, bands, lanes) of prepared documents; an empty set has null sketches."""
    schema = "doc_id long, crc long, key long, n long, digest binary, bands binary, lanes binary"
    names = [c.split()[0] for c in schema.split(", ")]

    def part(batch: pa.RecordBatch, lo: int, hi: int) -> pa.RecordBatch:
        here = batch.slice(lo, hi - lo)
        sets = shingle_sets(here.column("text").to_pylist(), size)
        full = [s for s in sets if len(s)]
        found: list[tuple] = []
        if full:
            mins = minima(full)
            bands, lanes = band_keys(mins), signatures(mins)
            found = [
                (xxhash.xxh128_digest(s.tobytes()), bands[i].tobytes(), lanes[i].tobytes()) for i, s in enumerate(full)
            ]
        each = iter(found)
        rows = [next(each) if len(s) else (None, None, None) for s in sets]
        digest, bands, lanes = map(list, zip(*rows, strict=True))
        cols = [*map(here.column, names[:3]), pa.array([len(s) for s in sets], pa.int64())]
        cols += [pa.array(c, pa.binary()) for c in (digest, bands, lanes)]
        return pa.RecordBatch.from_arrays(cols, names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lo = volume = 0
            for i, text in enumerate(batch.column("text")):
                volume += len(text.as_buffer())
                if volume > 6 * CHUNK_WORDS:
                    yield part(batch, lo, i + 1)
                    lo, volume = i + 1, 0
            if lo < batch.num_rows:
                yield part(batch, lo, batch.num_rows)

    ship(docs.sparkSession)
    return docs.select("doc_id", "crc", "key", "text").mapInArrow(run, schema)


def with_crc(docs: DataFrame) -> DataFrame:
    """(doc_id, crc, key, text), null texts empty; the key, a 64-bit digest, tells rows with equal doc_id apart."""
    text = F.coalesce(F.col("text"), F.lit(""))
    crc = F.crc32(text.cast("binary")).alias("crc")
    return docs.select(F.col("doc_id").cast("long"), crc, F.xxhash64(text).alias("key"), text.alias("text"))


def _blocks(rows: DataFrame, blocks: str, *group: str) -> DataFrame:
    """Deals the rows of a group into `blocks` blocks and gives each pair of blocks a group of its own."""
    mine = F.pmod(F.xxhash64("node"), F.col(blocks)).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col(blocks).cast("int") - 1))
    many = rows.withColumn("mine", mine).withColumn("other", other)
    # one block alone is (0, 0); of more, a block meets itself within its pairs
    many = many.where((F.col(blocks) == 1) | (F.col("mine") != F.col("other")))
    pair = [F.least("mine", "other").alias("block_a"), F.greatest("mine", "other").alias("block_b")]
    return many.select(*group, *pair, *[c for c in rows.columns if c not in (*group, blocks)])


def _edges(node: np.ndarray, found: list[tuple[int, int]]) -> Iterator[pa.RecordBatch]:
    if found:
        i, root = np.array(found).T
        yield pa.RecordBatch.from_arrays([pa.array(node[i]), pa.array(node[root])], ["u", "v"])


def candidate_edges(nodes: DataFrame, threshold: float) -> DataFrame:
    """Edges that span the clusters of nodes (node, bands, lanes) with a lenient estimate in a shared bucket."""
    least = lenient(threshold)

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            keys = np.frombuffer(b"".join(batch.column("bands").to_pylist()), np.int64)
            at = np.repeat(np.arange(n), BANDS)
            node = batch.column("node").to_numpy()[at]
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys), pa.array(node), batch.column("lanes").take(pa.array(at))], ["key", "node", "lanes"]
            )

    def work(group: pa.Table) -> Iterator[pa.RecordBatch]:
        group = group.sort_by("node")  # so that the smallest node is the root
        node = group.column("node").to_numpy()
        lanes = np.frombuffer(b"".join(group.column("lanes").to_pylist()), np.uint64).reshape(len(node), -1)
        yield from _edges(node, reach(len(node), lambda i, rest: estimate(lanes[i], lanes[rest]) >= least))

    entries = nodes.select("node", "bands", "lanes").mapInArrow(explode, "key long, node long, lanes binary")
    shared = entries.groupBy("key").count().where("count > 1")
    blocks = F.ceil(F.col("count") / BUCKET_BLOCK)
    joined = entries.join(shared, "key").withColumn("blocks", F.when(blocks > 1, blocks + 1).otherwise(1).cast("int"))
    rows = _blocks(joined.drop("count"), "blocks", "key")
    return grouped(rows, ["key", "block_a", "block_b"], work, "u long, v long", least=2).distinct()


def confirmed_groups(members: DataFrame, docs: DataFrame, size: int, percent: int) -> DataFrame:
    """Members linked on full sets within clusters: (u, v, digest, low, parts), v standing for the reached ones.

    `members`: (node, digest, doc_id, key, cluster, blocks). `low` is the smallest doc_id that the search
    reached. Where `parts` is 1 the cluster was searched as a whole, so that is the component's.
    """
    schema = "cluster long, node long, doc_id long, digest binary, blocks int, shingles binary"
    names = [c.split()[0] for c in schema.split(", ")]

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                here = batch.slice(lo, 256)
                found = [s.tobytes() for s in shingle_sets(here.column("text").to_pylist(), size)]
                yield pa.RecordBatch.from_arrays([*[here.column(c) for c in names[:-1]], pa.array(found, pa.binary())], names)

    def work(group: pa.Table) -> Iterator[pa.RecordBatch]:
        group = group.sort_by("node")
        found = linked_sets([np.frombuffer(s, np.uint64) for s in group.column("shingles").to_pylist()], percent)
        if not found:
            return
        node, digest, ids = (group.column(c).to_pylist() for c in ("node", "digest", "doc_id"))
        root = dict(found)
        root |= {r: r for r in root.values()}
        low: dict[int, int] = {}
        for i, r in root.items():
            if ids[i] is not None:
                low[r] = min(ids[i], low.get(r, ids[i]))
        rows = [(node[i], node[r], digest[i], low.get(r), group.column("parts")[0].as_py()) for i, r in root.items()]
        kinds = [pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int32()]
        arrays = [pa.array(list(c), k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
        yield pa.RecordBatch.from_arrays(arrays, ["u", "v", "digest", "low", "parts"])

    null_safe = docs["doc_id"].eqNullSafe(members["doc_id"]) & (docs["key"] == members["key"])
    # by shuffle at every size: whether the members are few enough to broadcast depends on the corpus
    texts = docs.join(members.hint("merge"), null_safe).select(
        "cluster", "node", members["doc_id"], "digest", "blocks", "text"
    )
    full = texts.mapInArrow(sets, schema).withColumn("parts", F.col("blocks"))
    rows = _blocks(full, "blocks", "cluster")
    schema = "u long, v long, digest binary, low long, parts int"
    return grouped(rows, ["cluster", "block_a", "block_b"], work, schema, least=2)


def _lowest_ids(links: DataFrame) -> DataFrame:
    """(digest, component_id, root) of linked nodes. Clusters searched in parts are put together first."""
    whole = links.where("parts = 1").select("digest", F.col("low").alias("component_id"), F.col("v").alias("root"))
    parts = links.where("parts > 1")
    if parts.isEmpty():
        return whole
    linked = components(parts.select("u", "v"))
    named = parts.select("u", "digest", "low").join(linked, F.col("u") == F.col("node"))
    lowest = named.groupBy("root").agg(F.min("low").alias("component_id"))
    return whole.unionByName(named.join(lowest, "root").select("digest", "component_id", "root").distinct())


def linked(docs: DataFrame, shingle: int, percent: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Sketches of all rows, one node per distinct set with its smallest row, and what `_lowest_ids` gives."""
    base = with_crc(docs)
    sketches = written(sketch(base, shingle), "minhash-sketch")
    distinct = sketches.where(F.col("digest").isNotNull()).groupBy("digest").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "key")).alias("best"),
        *[F.first(c).alias(c) for c in ("n", "bands", "lanes")],
    )
    nodes = distinct.select(
        F.monotonically_increasing_id().alias("node"), "digest", "best.doc_id", "best.key", "n", "bands", "lanes"
    )
    nodes = written(nodes, "minhash-nodes")
    clusters = components(candidate_edges(nodes, percent / 100))
    members = nodes.select("node", "digest", "doc_id", "key", "n").join(clusters, "node")
    volume = members.groupBy("root").agg(F.ceil(F.sum("n") / CLUSTER_BLOCK).alias("blocks"))
    blocks = F.when(F.col("blocks") > 1, F.col("blocks") + 1).otherwise(1).cast("int")
    members = members.join(volume.select("root", blocks.alias("blocks")), "root").withColumnRenamed("root", "cluster")
    links = written(confirmed_groups(members, base, shingle, percent), "minhash-links")
    return sketches, nodes, _lowest_ids(links)


def near_duplicates(docs: DataFrame, *, shingle: int = 5, percent: int = 80) -> DataFrame:
    """One row per row of `docs` (doc_id, text): doc_id, text_crc32, n_shingles, component_id, kept.

    Documents are linked if 100 * intersection >= percent * union of their shingle sets; component_id is the
    smallest doc_id reachable over links, `kept` whether it is the row's own. Fewer words than `shingle` make
    one shingle of all; no words or a null text make an empty set, which is linked with nothing. A null doc_id
    counts as larger than all others. Rows with equal doc_id and text have equal results. An empty table gives
    no rows; other columns are ignored.
    """
    sketches, nodes, lowest = linked(docs, shingle, percent)
    by_digest = nodes.select("digest", F.col("doc_id").alias("first_id")).join(lowest, "digest", "left")
    by_digest = by_digest.select("digest", F.coalesce("component_id", "first_id").alias("component_id"))
    out = sketches.select("doc_id", "crc", "n", "digest").join(by_digest, "digest", "left")
    component = F.when(F.col("digest").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    n = F.col("n").alias("n_shingles")
    out = out.select("doc_id", F.col("crc").alias("text_crc32"), n, component.alias("component_id"))
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def one_of_each(docs: DataFrame, *, shingle: int = 5, percent: int = 80) -> DataFrame:
    """The rows of `docs`, with all their columns, that stand for their group: one with the smallest doc_id of each.

    A null doc_id counts as larger than all others; of several texts with that doc_id the one with the smallest
    digest stays. Rows equal in doc_id and text are one document, of which one row stays. A document with an
    empty set is a group of its own.
    """
    sketches, nodes, lowest = linked(docs, shingle, percent)
    row = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "key")).alias("best")
    groups = nodes.join(lowest.select("digest", "root"), "digest", "left")
    best = groups.groupBy(F.coalesce("root", "node").alias("root")).agg(row).select("best.doc_id", "best.key")
    best = best.unionByName(sketches.where(F.col("digest").isNull()).select("doc_id", "key"))
    keep = best.select(F.coalesce("doc_id", F.lit(NO_ID)).alias("id"), "key").distinct()
    rows = docs.select(F.struct("*").alias("row"), F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("id"))
    rows = rows.withColumn("key", F.xxhash64(F.coalesce("row.text", F.lit(""))))
    return rows.join(keep, ["id", "key"]).dropDuplicates(["id", "key"]).select("row.*")


def op4_bbit_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of all documents by 2-word shingles at 0.8."""
    return near_duplicates(table(spark, sf_dir, "documents"), shingle=2).drop("text_crc32")


def near_duplicates_sql(shingle: int, documents: str = "documents") -> str:
    """DuckDB SQL for `near_duplicates` by exact counting; doc_ids must be unique and not null."""
    return f"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS words FROM {documents}),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(words) = 0 THEN []
           WHEN len(words) < {shingle} THEN [array_to_string(words, ' ')]
           ELSE list_transform(range(1, len(words) - {shingle} + 2),
                               lambda i: array_to_string(words[i:i + {shingle - 1}], ' ')) END) AS shingle
  FROM w),
c AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
pairs AS (
  SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS common
  FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS MATERIALIZED (
  SELECT u, v FROM pairs JOIN c x ON x.doc_id = u JOIN c y ON y.doc_id = v
  WHERE 100 * common >= 80 * (x.n + y.n - common)),
reached AS (
  SELECT doc_id AS u, doc_id AS v FROM {documents}
  UNION
  SELECT reached.u, links.v FROM reached JOIN links ON links.u = reached.v),
lowest AS (SELECT u AS doc_id, min(v) AS component_id FROM reached GROUP BY u)
SELECT w.doc_id, coalesce(c.n, 0) AS n_shingles, component_id, w.doc_id = component_id AS kept
FROM w JOIN lowest USING (doc_id) LEFT JOIN c ON c.doc_id = w.doc_id"""
