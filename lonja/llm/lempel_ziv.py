"""Substring dedup by a relative Lempel-Ziv parse of every document against all earlier text.

A factor is a stretch of at least `window` words that also starts earlier in the corpus (smaller doc_id, or
the same document further left). The parse has three steps:

1. Anchors. The smallest hash of the `anchor`-word runs inside a window names the window's anchor, so equal
   windows have equal anchors at equal offsets. Consecutive windows with the same anchor form one piece (some
   eight windows), which is the unit that is indexed: (anchor, digest of the piece, document, start).
2. Reference blocks. Pieces are dealt into blocks by anchor and sorted, so each block is an index of a share of
   the corpus, and every document is parsed against every block that has one of its anchors. A piece whose
   digest is found at an earlier place is a copy of it: all its windows are duplicate. Pieces that join up in
   document and source form one factor. Hashed pieces replace a greedy parse word by word, which would need all
   earlier text in one place: a long copy whose pieces first occur in different documents is several factors.
3. Factor boundaries. Where an anchor occurs with different surroundings, a factor ends inside a piece; one
   piece of each kind has its windows looked up one by one in the same way.

The result is exact up to 64-bit hashes of word runs and of the texts of rows with equal doc_id. A block is read as a sorted stream that holds one piece
at a time, and equal pieces of a batch are combined before the shuffle, so frequent passages cost little.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lonja.llm.common import partitions, ship, table, written

WINDOW, ANCHOR = 20, 5
CHUNK_WORDS = 200_000
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
FIRST_ID = -(1 << 63)
COPY, EDGE = 1, 2

INDEX_SCHEMA = "route long, kind int, anchor long, piece long, doc long, key long, at long, src_doc long, src_start int"
FOUND_SCHEMA = "kind int, doc long, key long, at long, src_doc long, src_start int"
NAMES = {x: [c.split()[0] for c in x.split(", ")] for x in (INDEX_SCHEMA, FOUND_SCHEMA)}


def split_words(text: str | None) -> list[bytes]:
    """Runs of bytes other than space and \\x09-\\x0D, which is what bytes.split() gives."""
    return (text or "").encode().split()


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values over all bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        steps = np.full(max(n, CHUNK_WORDS) + 1, base, np.uint64)
        steps[0] = 1
        have = _powers[base] = np.multiply.accumulate(steps)
    return have[:n]


class Runs:
    """Hashes of word runs of any length, from prefix sums of one hash per word."""

    def __init__(self, words: list[bytes]):
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
        self.sums = np.zeros(len(words) + 1, np.uint64)
        np.cumsum(hashes * powers(BASE, len(words)), out=self.sums[1:])

    def __call__(self, start: np.ndarray, length: np.ndarray | int) -> np.ndarray:
        back = powers(INVERSE, len(self.sums))
        return mix((self.sums[start + length] - self.sums[start]) * back[start])


def leftmost_min(values: np.ndarray, width: int) -> np.ndarray:
    """Index of the leftmost smallest of each `width` neighbours."""
    at, have = np.arange(len(values)), 1
    while have < width:
        step = min(have, width - have)
        a, b = at[:-step], at[step:]
        at, have = np.where(values[a] <= values[b], a, b), have + step
    return at


def pack(start: np.ndarray, count: np.ndarray | int) -> np.ndarray:
    """Start and number of windows; sorts by start."""
    return (start.astype(np.int64) << 32) | count


def start_of(at: np.ndarray) -> np.ndarray:
    return at >> 32


def pieces(words: list[bytes], ends: np.ndarray, window: int, anchor: int):
    """(first window, number of windows, anchor hash, piece digest) of all pieces; `ends`: of documents."""
    if len(words) < window:
        return (np.zeros(0, np.int64),) * 2 + (np.zeros(0, np.uint64),) * 2
    run = Runs(words)
    hashes = run(np.arange(len(words) - anchor + 1), anchor)
    at = leftmost_min(hashes, window - anchor + 1)
    starts = np.arange(len(words) - window + 1)
    inside = ends[np.searchsorted(ends, starts, side="right")] >= starts + window
    starts, at = starts[inside], at[inside]
    new = np.ones(len(starts), bool)
    new[1:] = (at[1:] != at[:-1]) | (starts[1:] != starts[:-1] + 1)
    first = np.flatnonzero(new)
    count = np.diff(np.append(first, len(starts)))
    starts, at = starts[first], at[first]
    whole = run(starts, count + window - 1)
    shape = ((at - starts) << 8 | count).astype(np.uint64)
    return starts, count, hashes[at], mix(whole ^ mix(shape))


def _index_batch(rows: list[np.ndarray]) -> pa.RecordBatch:
    """Index rows of (anchor, piece, doc, key, at); a piece equal to an earlier one of the batch is a found copy."""
    anchor, piece, doc, key, at = (np.concatenate(x) for x in zip(*rows, strict=True))
    order = np.lexsort((key, at, doc, piece, anchor))
    anchor, piece, doc, key, at = anchor[order], piece[order], doc[order], key[order], at[order]
    new = np.ones(len(at), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (piece[1:] != piece[:-1])
    first = np.maximum.accumulate(np.where(new, np.arange(len(at)), 0))
    copy = (doc > doc[first]) | (start_of(at) > start_of(at[first]))
    spread = mix(doc.view(np.uint64) ^ key.view(np.uint64) ^ at.view(np.uint64))
    route = np.where(copy, spread.view(np.int64), anchor)
    cols = [route, copy.astype(np.int32), anchor, piece, doc, key, at, doc[first], start_of(at[first]).astype(np.int32)]
    mask = ~copy
    arrays = [pa.array(c) for c in cols[:7]] + [pa.array(c, mask=mask) for c in cols[7:]]
    return pa.RecordBatch.from_arrays(arrays, NAMES[INDEX_SCHEMA])


def _columns(batch: pa.RecordBatch, *names: str) -> list[np.ndarray]:
    return [batch.column(n).to_numpy(zero_copy_only=False) for n in names]


def _chunks(batch: pa.RecordBatch, *more: str):
    """Documents of a batch in groups of some CHUNK_WORDS words: (words, ends, rows of the other columns)."""
    others = [batch.column(c).to_pylist() for c in more]
    words, ends, rows = [], [], []
    for i, text in enumerate(batch.column("text")):
        words += split_words(text.as_py())
        ends.append(len(words))
        rows.append([o[i] for o in others])
        if len(words) >= CHUNK_WORDS:
            yield words, np.array(ends), rows
            words, ends, rows = [], [], []
    if rows:
        yield words, np.array(ends), rows


def index_pieces(docs: DataFrame, window: int, anchor: int) -> DataFrame:
    """All pieces of prepared documents (doc, key, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for words, ends, rows in _chunks(batch, "doc", "key"):
                start, count, a, g = pieces(words, ends, window, anchor)
                if len(start):
                    of = np.searchsorted(ends, start, side="right")
                    doc, key = (np.array(x, np.int64) for x in zip(*rows, strict=True))
                    begins = np.append(0, ends[:-1])
                    at = pack(start - begins[of], count)
                    found.append((a.view(np.int64), g.view(np.int64), doc[of], key[of], at))
            if found:
                yield _index_batch(found)

    return docs.mapInArrow(run, INDEX_SCHEMA)


def index_windows(edges: DataFrame, window: int) -> DataFrame:
    """Every window of the pieces in `edges` (doc, key, text, ats) as index rows of its own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for words, ends, rows in _chunks(batch, "doc", "key", "ats"):
                hashes, begin = Runs(words), 0
                for end, (doc, key, ats) in zip(ends, rows, strict=True):
                    ats = np.array(ats, np.int64)
                    count = ats & 0xFF
                    start = np.repeat(start_of(ats) - np.cumsum(count) + count, count) + np.arange(count.sum())
                    w = hashes(start + begin, window).view(np.int64)
                    found.append((w, w, *(np.full(len(w), x, np.int64) for x in (doc, key)), pack(start, 1)))
                    begin = end
            if found:
                yield _index_batch(found)

    return edges.mapInArrow(run, INDEX_SCHEMA)


def match_blocks(index: DataFrame) -> DataFrame:
    """Finds copies inside the sorted reference blocks; pieces at factor boundaries are kind EDGE.

    Each block is one sorted stream. What is carried from batch to batch is the first place of the current
    piece and whether its anchor has shown another piece.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # (anchor, piece, doc, key, at, known as an edge)
        for batch in batches:
            if not batch.num_rows:
                continue
            kind, a, g, doc, key, at = _columns(batch, "kind", "anchor", "piece", "doc", "key", "at")
            ready = batch.filter(pa.array(kind == COPY)).select(NAMES[FOUND_SCHEMA])
            if ready.num_rows:
                yield ready
            rest = kind != COPY
            a, g, doc, key, at = a[rest], g[rest], doc[rest], key[rest], at[rest]
            if not len(a):
                continue
            edge = np.zeros(len(a) + bool(held), bool)
            if held:
                a, g, doc, key, at = (np.append(h, x) for h, x in zip(held, (a, g, doc, key, at), strict=False))
            new = np.ones(len(a), bool)
            new[1:] = (a[1:] != a[:-1]) | (g[1:] != g[:-1])
            first = np.maximum.accumulate(np.where(new, np.arange(len(a)), 0))
            copy = (doc > doc[first]) | (start_of(at) > start_of(at[first]))
            heads = np.flatnonzero(new)
            same = a[heads[1:]] == a[heads[:-1]]
            edge[heads[1:][same]] = edge[heads[:-1][same]] = True
            last = heads[-1]
            known = bool(edge[last] or (held and last == 0 and held[5]))
            if held and held[5]:
                edge[0] = False  # already given
            held = (a[last], g[last], doc[last], key[last], at[last], known)
            for what, mask in ((COPY, copy), (EDGE, edge)):
                if mask.any():
                    src = first[mask]
                    none = None if what == COPY else np.ones(len(src), bool)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(len(src), what, np.int32)),
                            pa.array(doc[mask]),
                            pa.array(key[mask]),
                            pa.array(at[mask]),
                            pa.array(doc[src], mask=none),
                            pa.array(start_of(at[src]).astype(np.int32), mask=none),
                        ],
                        NAMES[FOUND_SCHEMA],
                    )

    blocks = index.repartition(partitions(index.sparkSession), "route")
    return blocks.sortWithinPartitions("kind", "anchor", "piece", "doc", "at", "key").mapInArrow(run, FOUND_SCHEMA)


def prepared_columns() -> list:
    """doc, key and text: a null doc_id comes before all others, a null text has no words.

    `key` is a 64-bit digest of the text, which tells rows with equal doc_id apart.
    """
    doc = F.coalesce(F.col("doc_id").cast("long"), F.lit(FIRST_ID)).alias("doc")
    text = F.coalesce(F.col("text"), F.lit("")).alias("text")
    key = F.xxhash64(F.coalesce(F.col("text"), F.lit("")))
    return [doc, key.alias("key"), text]


def prepared(docs: DataFrame) -> DataFrame:
    return docs.select(*prepared_columns())


def copies(docs: DataFrame, *, window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """Found copies (doc, key, at, src_doc, src_start) of prepared documents, as a written table."""
    ship(docs.sparkSession)
    found = written(match_blocks(index_pieces(docs, window, anchor)), "lz-pieces")
    edges = found.where(F.col("kind") == EDGE).groupBy("doc", "key").agg(F.collect_set("at").alias("ats"))
    edges = docs.join(edges, ["doc", "key"])
    single = match_blocks(index_windows(edges, window)).where(F.col("kind") == COPY)
    single = written(single, "lz-windows")
    both = found.where(F.col("kind") == COPY).unionByName(single)
    return both.select("doc", "key", "at", "src_doc", "src_start")


def greedy_factors(hits: list[tuple[int, int, int]], window: int) -> list[tuple[int, int, int, int]]:
    """Copies (at, source doc, source start) of one document to factors (start, words, source doc, source start).

    A factor grows while the next copy continues both the document and the source.
    """
    out: list[list[int]] = []
    for at, src_doc, src in sorted(hits):
        start, count = at >> 32, at & 0xFF
        if out and out[-1][2] == src_doc and start - out[-1][0] == src - out[-1][3] == out[-1][1] - window + 1:
            out[-1][1] += count
        else:
            out.append([start, count + window - 1, src_doc, src])
    return [tuple(x) for x in out]


def _parsed(rows: DataFrame, window: int, extra: str = "") -> DataFrame:
    """Parses rows (doc, text, hits, and one `extra` column that is passed on)."""
    factor = pa.struct([(n, pa.int64()) for n in ("start", "words", "src_doc", "src_start")])
    schema = (
        "doc long, factors array<struct<start:long,words:long,src_doc:long,src_start:long>>, "
        "kept_words string, kept_text string, n_words long, n_removed long"
    )
    names = ["doc", "factors", "kept_words", "kept_text", "n_words", "n_removed"]

    def one(text: str, hits: list[dict] | None) -> tuple:
        factors = greedy_factors([tuple(h.values()) for h in hits or []], window)
        words = split_words(text)
        if not factors:
            return [], " ".join(w.decode() for w in words), text, len(words), 0
        keep = np.ones(len(words), bool)
        for start, n, _, _ in factors:
            keep[start : start + n] = False
        kept = keep.tolist()
        left = b" ".join([w for w, k in zip(words, kept, strict=True) if k]).decode()
        spaced = re.findall(rb"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+", text.encode())
        cut = b"".join([w for w, k in zip(spaced, kept, strict=True) if k]).decode()
        factors = [dict(zip(("start", "words", "src_doc", "src_start"), f, strict=True)) for f in factors]
        return factors, left, cut, len(words), len(words) - sum(kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            texts, hits = batch.column("text").to_pylist(), batch.column("hits").to_pylist()
            cols = map(list, zip(*map(one, texts, hits), strict=True))
            kinds = [pa.list_(factor), pa.string(), pa.string(), pa.int64(), pa.int64()]
            arrays = [batch.column("doc"), *[pa.array(c, k) for c, k in zip(cols, kinds, strict=True)]]
            more = [batch.column(extra)] if extra else []
            yield pa.RecordBatch.from_arrays(arrays + more, names + [extra] * len(more))

    if extra:
        schema += f", {extra} {rows.schema[extra].dataType.simpleString()}"
    return rows.mapInArrow(run, schema)


def _with_hits(rows: DataFrame, base: DataFrame, window: int, anchor: int) -> DataFrame:
    """`rows` with the copies found for their doc and key among the documents `base`.

    Equal rows find the same copies: each is taken once for all of them, so n equal rows cost n times one row.
    """
    found = copies(base, window=window, anchor=anchor)
    per_row = found.groupBy("doc", "key").agg(F.collect_set(F.struct("at", "src_doc", "src_start")).alias("hits"))
    return rows.join(per_row, ["doc", "key"], "left").drop("key")


def parse(docs: DataFrame, *, window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """`docs` (doc_id, text) to one row per row: doc_id, factors, kept_words, kept_text, n_words, n_removed.

    `factors`: array of (start, words, src_doc, src_start) in words; `kept_words`: the words outside of all
    factors, joined by one space; `kept_text`: the text without the other words and the blanks before them.
    Rows with equal doc_id are ranked equally: neither is earlier. Documents under `window` words, empty and
    null texts have no factor; an empty table gives no rows. Other columns are ignored.
    """
    base = prepared(docs)
    parsed = _parsed(_with_hits(base, base, window, anchor), window)
    return parsed.withColumn("doc", F.nullif("doc", F.lit(FIRST_ID))).withColumnRenamed("doc", "doc_id")


def cut_copies(docs: DataFrame, *, window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """`docs` with all rows and columns, texts without their factors and `n_chars`, if there, counted again.

    A text that has no factor stays as it is, null included; one that is all copies becomes empty.
    """
    base = prepared(docs)
    rows = docs.select(F.struct(*[c for c in docs.columns if c != "text"]).alias("row"), "doc_id", "text")
    keyed = rows.select("row", F.col("text").isNull().alias("no_text"), *prepared_columns())
    keyed = keyed.withColumn("row", F.struct("row", "no_text")).drop("no_text")
    parsed = _parsed(_with_hits(keyed, base, window, anchor), window, "row")
    text = F.when(F.col("row.no_text") & (F.col("n_words") == 0), F.lit(None)).otherwise(F.col("kept_text"))
    columns = [text.alias("text") if c == "text" else F.col(f"row.row.`{c}`") for c in docs.columns]
    if "n_chars" in docs.columns:
        n = F.when(F.col("n_removed") > 0, F.length("kept_text")).otherwise(F.col("row.row.n_chars"))
        columns[docs.columns.index("n_chars")] = n.cast(docs.schema["n_chars"].dataType).alias("n_chars")
    return parsed.select(*columns)


def op1_lempel_ziv_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the words of 20-word windows that start earlier, as digests of what is kept."""
    parsed = parse(table(spark, sf_dir, "documents"))
    return parsed.select("doc_id", "n_words", "n_removed", F.sha2("kept_words", 256).alias("kept_sha256"))


OP1_SQL = """
WITH w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words FROM documents),
t AS (SELECT doc_id, words, unnest(range(1, len(words) + 1)) AS i FROM w),
s AS (
  SELECT doc_id, i, words[i] AS word,
         CASE WHEN i + 19 <= len(words) THEN md5_number(array_to_string(words[i:i + 19], ' ')) END AS run
  FROM t),
d AS (
  SELECT *, CASE WHEN run IS NOT NULL
                 THEN row_number() OVER (PARTITION BY run ORDER BY doc_id, i) > 1 ELSE FALSE END AS again
  FROM s),
c AS (
  SELECT *, max(CAST(again AS INTEGER)) OVER (
              PARTITION BY doc_id ORDER BY i ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) = 1 AS gone
  FROM d),
g AS (
  SELECT doc_id, CAST(count(*) AS BIGINT) AS n_words, CAST(count(*) FILTER (WHERE gone) AS BIGINT) AS n_removed,
         coalesce(string_agg(word, ' ' ORDER BY i) FILTER (WHERE NOT gone), '') AS kept
  FROM c GROUP BY doc_id)
SELECT w.doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN g USING (doc_id)"""
