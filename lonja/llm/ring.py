"""Sharding on a consistent-hash ring with virtual nodes and bounded loads.

The ring has `cells` positions. Every shard owns `vnodes` of them, drawn by hash; a row's position is a
hash of its key, and its home is the first virtual node at or after that position. A shard takes at most
its capacity: rows that find it full continue clockwise to the next shard with room. With `slack=0` the
capacities add up to the row count, so shard sizes differ by one at most; with `slack=0.25` no shard holds
more than 1.25 times the mean, and fewer rows move when a shard is added.

Only the counts per cell (at most `cells * salts` numbers, whatever the data) reach the driver, which walks
the ring over counts; the rows get their place by joining that plan on their cell.
"""

from __future__ import annotations

from hashlib import blake2b
from math import ceil

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lonja.llm.common import table, written

CELLS = 1 << 14
SALTS = 4
VNODES = 128


def virtual_nodes(shards: int, vnodes: int = VNODES, cells: int = CELLS) -> list[tuple[int, int]]:
    """(cell, shard) of every virtual node in ring order. A shard's nodes don't depend on the others."""

    def at(shard: int, copy: int) -> int:
        return int.from_bytes(blake2b(f"{shard}/{copy}".encode(), digest_size=8).digest(), "big") % cells

    return sorted((at(s, c), s) for s in range(shards) for c in range(vnodes))


def capacities(rows: int, shards: int, slack: float = 0.0) -> list[int]:
    if slack:
        return [ceil(rows / shards * (1 + slack))] * shards
    return [rows // shards + (s < rows % shards) for s in range(shards)]


def walk(counts: dict[tuple[int, int], int], shards: int, *, vnodes: int, cells: int, slack: float):
    """Places counted rows: (cell, salt, first rank, end rank, shard, first slot).

    All rows first ask their home shard, then, round by round, those that were turned away ask the next
    different shard clockwise. Within a round, arcs are served in ring order.
    """
    nodes = virtual_nodes(shards, vnodes, cells)
    room = capacities(sum(counts.values()), shards, slack)
    used = [0] * shards
    arcs: list[list[tuple[int, int, int, int]]] = [[] for _ in nodes]
    k = 0
    for (cell, salt), n in sorted(counts.items()):
        while k < len(nodes) and nodes[k][0] < cell:
            k += 1
        arcs[k % len(nodes)].append((cell, salt, 0, n))
    routes = []
    for k in range(len(nodes)):
        seen = dict.fromkeys(nodes[(k + i) % len(nodes)][1] for i in range(len(nodes)))
        routes.append(list(seen))
    plan = []
    for turn in range(shards):
        for k, pending in enumerate(arcs):
            if not pending:
                continue
            shard, left = routes[k][turn], []
            for cell, salt, lo, hi in pending:
                taken = min(hi - lo, room[shard] - used[shard])
                if taken:
                    plan.append((cell, salt, lo, lo + taken, shard, used[shard]))
                    used[shard] += taken
                if lo + taken < hi:
                    left.append((cell, salt, lo + taken, hi))
            arcs[k] = left
    return plan


def assign(
    rows: DataFrame,
    key: list[str],
    *,
    shards: int,
    order: list[str] | None = None,
    slack: float = 0.0,
    vnodes: int = VNODES,
    cells: int = CELLS,
) -> DataFrame:
    """Adds `shard` and `slot` (gapless from 0 in each shard) to `rows`, which are written out once.

    `key` decides the ring position; a null key has a position too. `order` ranks the rows of one cell;
    rows equal in key and order are interchangeable. Rows of a frequent key are ranked in `SALTS` parts.
    An empty input gives an empty result. `rows` must not have columns named like the added ones.
    """
    spark = rows.sparkSession
    cell = F.pmod(F.xxhash64(*key), F.lit(cells)).cast("int")
    salt = F.pmod(F.spark_partition_id(), F.lit(SALTS))
    base = written(rows.select("*", cell.alias("ring_cell"), salt.alias("ring_salt")), "ring")
    tally = base.groupBy("ring_cell", "ring_salt").count().collect()
    plan = walk({(c, s): n for c, s, n in tally}, shards, vnodes=vnodes, cells=cells, slack=slack)
    schema = "ring_cell int, ring_salt int, ring_lo long, ring_hi long, shard int, ring_slot long"
    plan = spark.createDataFrame(plan, schema)
    by = Window.partitionBy("ring_cell", "ring_salt").orderBy(*key, *(order or []))
    ranked = base.withColumn("ring_rank", F.row_number().over(by).cast("long") - 1)
    inside = (F.col("ring_rank") >= F.col("ring_lo")) & (F.col("ring_rank") < F.col("ring_hi"))
    slot = (F.col("ring_slot") + F.col("ring_rank") - F.col("ring_lo")).alias("slot")
    return ranked.join(plan, ["ring_cell", "ring_salt"]).where(inside).select(*rows.columns, "shard", slot)


def size_bytes(text: Column) -> Column:
    """UTF-8 bytes of a text (null: none) plus 8 for its identifier."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 8).cast("long")


def write_shards(docs: DataFrame, placed: DataFrame, path: str, *, on: str = "doc_id") -> None:
    """Writes `docs` into folders `shard=<n>`, each file sorted by slot. `on` must be unique."""
    joined = docs.join(placed.select(on, "shard", "slot"), on)
    joined = joined.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
    joined.write.partitionBy("shard").parquet(path)


def op5_bounded_ring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 24 shards whose counts are at most one apart (law `rows`).

    A null text has size 8 and the CRC of no bytes. Repeated rows get a slot each; a null doc_id is a key
    like another. The method has no groups of texts: equal texts may lie in different shards.
    """
    docs = table(spark, sf_dir, "documents")
    rows = docs.select(
        "doc_id",
        size_bytes(F.col("text")).alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"),
    )
    placed = assign(rows, ["doc_id"], shards=24, order=["text_crc32", "size"])
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
