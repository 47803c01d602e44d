"""Lexical retrieval packing: windows filled with the nearest unused documents by BM25.

Every document's ids are cut into full windows, which are sequences of their own, and a tail shorter than a
window. Tails are dealt by content (`tail_routes.py`) into shards of at most about `SHARD_TOKENS`, each with an
inverted index of its own, so a tail's neighbours are in its shard however many shards there are; the
document frequencies behind the weights are counted over the whole texts of all documents, term frequencies and
lengths over tails, which are what is retrieved. In a shard the first unused tail seeds
a window, its heaviest terms query the index, and the unused neighbours fill the window in the order of their
scores. The one that no longer fits is cut, and its rest seeds the next window, so only the last window of a
shard has padding. The terms of the index are token ids.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import pairwise
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers
from lonja.llm import tail_routes
from lonja.llm.common import discard, grouped, ship, table, written
from lonja.llm.word_ids import numbering, slices, word_ids

WINDOW, END_ID = 2048, 1
SHARD_TOKENS, ROW_COST = 2_000_000, 64
QUERY_TERMS, RANKED_FIRST = 24, 64
K1, B = 1.2, 0.75
SLICE_BYTES = 6_000_000

PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
)


def tokenised(docs: DataFrame, path: str, *, window: int, end_id: int, with_ids: bool) -> DataFrame:
    """One row per document: its token count, the CRCs of its full windows, its tail and, if asked for, their ids.

    `more`: the distinct ids of the full windows that the tail has not.
    """
    schema = "doc_id long, doc_tokens long, head_crcs binary, more binary, head binary, tail binary"
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_ids(path)
        end = np.array([end_id], encoder.kind)
        size = window * end.itemsize
        for batch in batches:
            texts = batch.column("text")
            for lo, count in slices(texts, SLICE_BYTES):
                flat, at = encoder.encode(texts.slice(lo, count))
                rows = []
                for a, b in pairwise(at.tolist()):
                    ids = np.append(flat[a:b], end).tobytes()
                    cut = len(ids) // size * size
                    crcs = [crc(ids[i : i + size], encoder.kind) for i in range(0, cut, size)]
                    head = ids[:cut] if with_ids else None
                    full, tail = np.frombuffer(ids[:cut], encoder.kind), np.frombuffer(ids[cut:], encoder.kind)
                    more = np.setdiff1d(full, tail).tobytes() if cut else b""
                    rows.append((b - a + 1, np.array(crcs, "<u4").tobytes(), more, head, ids[cut:]))
                n, *found = map(list, zip(*rows, strict=True))
                cols = [pa.array(n, pa.int64()), *[pa.array(c, pa.binary()) for c in found]]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(lo, count), *cols], names)

    ship(docs.sparkSession)
    text = F.coalesce(F.col("text"), F.lit("")).alias("text")
    return docs.select(F.col("doc_id").cast("long"), text).mapInArrow(run, schema)


def crc(ids: bytes, kind: str) -> int:
    """CRC-32 of ids as little-endian unsigned 32-bit integers."""
    return zlib.crc32(np.frombuffer(ids, kind).astype("<u4").tobytes())


def frequencies(tokens: DataFrame, vocabulary: int, kind: str) -> tuple[np.ndarray, int, float]:
    """In how many whole documents each id occurs, the number of documents, and the mean length of their tails.

    Each task adds up a vector; the sums come to the driver, one row per id that occurs.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, rows, tails, length = np.zeros(vocabulary, np.int64), 0, 0, 0
        for batch in batches:
            for lo in range(0, batch.num_rows, tail_routes.SLICE_ROWS):
                some = batch.slice(lo, tail_routes.SLICE_ROWS)
                ids, size = tail_routes.flat(some.column("tail"), kind)
                key = np.sort(np.repeat(np.arange(len(size)) * vocabulary, size) + ids)  # an id counts once a document
                seen += np.bincount(key[np.diff(key, prepend=-1) > 0] % vocabulary, minlength=vocabulary)
                more, _ = tail_routes.flat(some.column("more"), kind)  # distinct, and none of the tail's
                seen += np.bincount(more, minlength=vocabulary)
                rows += len(size)
                tails += int((size > 0).sum())
                length += len(ids)
        at = np.flatnonzero(seen)
        term, n = np.append(at, [-1, -2, -3]), np.append(seen[at], [rows, tails, length])
        yield pa.RecordBatch.from_arrays([pa.array(term), pa.array(n)], ["term", "n"])

    parts = tokens.select("tail", "more").mapInArrow(run, "term long, n long")
    found = parts.groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    term, n = (found.column(c).to_numpy() for c in ("term", "n"))
    df = np.zeros(vocabulary + 3, np.int64)  # the last three: mean's parts and the number of documents
    df[term] = n
    length, tails, rows = df[-3:].tolist()
    return df[:vocabulary], rows, length / max(1, tails)


def rarity(df: np.ndarray, rows: int) -> np.ndarray:
    """The inverse document frequency of every id."""
    return np.log1p((rows - df + 0.5) / (df + 0.5))


class Index:
    """A shard's inverted index with BM25 weights."""

    def __init__(self, tails: list[np.ndarray], df: np.ndarray, rows: int, mean: float):
        size = np.array([len(t) for t in tails])
        owner = np.repeat(np.arange(len(tails)), size)
        keys, tf = np.unique(owner * len(df) + np.concatenate(tails), return_counts=True)
        doc, term = np.divmod(keys, len(df))
        self.idf = rarity(df, rows)
        norm = K1 * (1 - B + B * size[doc] / mean)
        weight = (tf * (K1 + 1) / (tf + norm)).astype(np.float32)
        order = np.argsort(term, kind="stable")
        self.first = np.searchsorted(term[order], np.arange(len(df) + 1))
        self.docs, self.weights = doc[order], weight[order]
        self.term, self.rare = term, self.idf[term] * weight
        self.bounds = np.searchsorted(doc, np.arange(len(tails) + 1))
        self.n = len(tails)

    def neighbours(self, seed: int, unused: np.ndarray) -> Iterator[int]:
        """Unused documents that share one of the seed's heaviest terms, best first, ties in order."""
        lo, hi = self.bounds[seed], self.bounds[seed + 1]
        best = np.argsort(-self.rare[lo:hi], kind="stable")[:QUERY_TERMS]
        scores = np.zeros(self.n, np.float32)
        for t in self.term[lo:hi][best].tolist():
            a, b = self.first[t], self.first[t + 1]
            scores[self.docs[a:b]] += self.weights[a:b] * self.idf[t]
        found = np.flatnonzero((scores > 0) & unused)
        score = scores[found]
        if len(found) > RANKED_FIRST:  # a window rarely takes more; the others are sorted when it does
            least = -np.partition(-score, RANKED_FIRST)[RANKED_FIRST]
            parts = [score >= least, score < least]
        else:
            parts = [np.ones(len(found), bool)]
        for part in parts:
            yield from found[part][np.argsort(-score[part], kind="stable")].tolist()


def fill(index: Index, sizes: list[int], window: int) -> list[tuple[int, int, int, int, int]]:
    """(document, start, length, sequence, offset) of all tails' pieces."""
    unused, after, out, sequence = np.ones(len(sizes), bool), 0, [], 0
    rest = None  # (document, start) of what was cut off
    while True:
        ranked, seed, offset = None, None, 0
        while offset < window:
            if rest:
                (doc, start), rest = rest, None
            else:
                if ranked is None and seed is not None:
                    ranked = index.neighbours(seed, unused)
                doc, start = next(ranked, None) if ranked else None, 0
                if doc is None:  # a new seed, or no neighbour left
                    while after < len(sizes) and not unused[after]:
                        after += 1
                    if after == len(sizes):
                        return out
                    doc = after
                unused[doc] = False
            seed = doc if seed is None else seed
            n = min(sizes[doc] - start, window - offset)
            if n:
                out.append((doc, start, n, sequence, offset))
                offset += n
            if start + n < sizes[doc]:
                rest = (doc, start + n)
        sequence += 1


def pack(
    docs: DataFrame,
    path: str,
    *,
    window: int = WINDOW,
    end_id: int = END_ID,
    shard_tokens: int = SHARD_TOKENS,
    with_ids: bool = False,
) -> DataFrame:
    """Pieces of `docs` (doc_id, text) in sequences of at most `window` ids; `with_ids` adds them as binary.

    A document is its text's ids, then `end_id`; null and empty texts are `end_id` alone. doc_id may be null
    or repeated, every row is a document of its own. Other columns are ignored; no rows give no pieces.
    """
    spark = docs.sparkSession
    kind, vocabulary = numbering(spark, path)
    vocabulary = max(vocabulary, end_id + 1)
    tokens = tokenised(docs, path, window=window, end_id=end_id, with_ids=with_ids)
    deal = F.xxhash64("doc_id", F.spark_partition_id(), F.monotonically_increasing_id())
    tokens = written(tokens.withColumn("deal", deal), "packing-tokens")
    df, rows, mean = frequencies(tokens, vocabulary, kind)
    volume = tokens.agg(F.sum(F.length("tail") / np.dtype(kind).itemsize + ROW_COST)).first()[0]
    sketch = tail_routes.Sketch.of(rarity(df, rows))
    tree = tail_routes.fit(tokens, sketch, kind, rows, ceil((volume or 0) / shard_tokens))
    routed = written(tail_routes.with_leaf(tokens.drop("more"), sketch, tree, kind), "packing-routed")
    discard(tokens)
    size = F.sum(F.length("tail") / np.dtype(kind).itemsize + ROW_COST)
    sizes = dict(routed.groupBy("leaf").agg(size).collect())  # a row per leaf
    tokens = tail_routes.with_shard(routed, *tail_routes.shards(sizes, tree.leaves, shard_tokens))
    weights = spark.sparkContext.broadcast((df, rows, mean))
    schema = PIECES + (", ids binary" if with_ids else "")

    def work(group: pa.Table) -> Iterator[pa.RecordBatch]:
        group = group.sort_by([("doc_id", "ascending"), ("deal", "ascending")])
        base = group.column("shard")[0].as_py() << 32
        doc_id, total = group.column("doc_id").to_pylist(), group.column("doc_tokens").to_pylist()
        tails = [np.frombuffer(t, kind) for t in group.column("tail").to_pylist()]
        found, number = [], 0
        for i, crcs in enumerate(group.column("head_crcs").to_pylist()):
            for k, c in enumerate(np.frombuffer(crcs, "<u4").tolist()):
                found.append((i, k * window, window, c, number, 0))
                number += 1
        full = [len(h) // 4 * window for h in group.column("head_crcs").to_pylist()]
        index = Index(tails, *weights.value)
        for i, start, n, sequence, offset in fill(index, [len(t) for t in tails], window):
            c = zlib.crc32(tails[i][start : start + n].astype("<u4").tobytes())
            found.append((i, full[i] + start, n, c, number + sequence, offset))
        i, start, n, c, sequence, offset = map(list, zip(*found, strict=True))
        cols = [[doc_id[k] for k in i], start, n, c, [total[k] for k in i], [base + s for s in sequence], offset]
        arrays = [pa.array(x, pa.int64()) for x in cols]
        if with_ids:
            whole = [
                np.append(np.frombuffer(h, kind), t).astype("<u4")
                for h, t in zip(group.column("head").to_pylist(), tails, strict=True)
            ]
            arrays.append(pa.array([whole[k][s : s + m].tobytes() for k, s, m in zip(i, start, n, strict=True)], pa.binary()))
        yield pa.RecordBatch.from_arrays(arrays, [x.split()[0] for x in schema.split(", ")])

    return grouped(tokens, ["shard"], work, schema)


def op3_bm25_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of 2048 ids of word_bpe_49k."""
    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
