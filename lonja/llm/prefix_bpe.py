"""Byte-level BPE by dynamic programming over byte prefixes.

For every prefix of a piece there is exactly one token that can end its encoding: a token that is a suffix
of the prefix, that merging its own bytes gives back, and that doesn't merge into the token ending the rest.
Storing this last token per prefix encodes a piece from left to right, so bytes can be appended without
touching what is there, and after an edit the table is recomputed only until it agrees with the old one over
the length of the longest token. The encoding is read backwards from the last entry.
"""

from __future__ import annotations

import base64
import hashlib
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import pairwise

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers
from lonja.llm.common import ship, table

CACHED_PIECES = 400_000
CACHED_PAIRS = 500_000
CACHED_STEMS = 100_000
STEM, LONG = 8, 64


class Ranks:
    """A vocabulary of merge ranks with the checks that the prefix table needs."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            self.rank = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.token = {r: t for t, r in self.rank.items()}
        self.longest = max(map(len, self.rank))
        self._bits = max(self.token).bit_length()
        self._fits: dict[int, bool] = {}
        self._tokens = ahocorasick.Automaton()
        for data, t in self.rank.items():
            if self.merge(data) == [t]:
                self._tokens.add_word(data.decode("latin-1"), (t, len(data)))
        self._tokens.make_automaton()

    def merge(self, piece: bytes) -> list[int]:
        """Plain merging, lowest rank first and leftmost on ties; for pieces of a few tokens."""
        rank, parts = self.rank.get, [piece[i : i + 1] for i in range(len(piece))]
        while True:
            best, at = None, 0
            for i, (a, b) in enumerate(pairwise(parts)):
                r = rank(a + b)
                if r is not None and (best is None or r < best):
                    best, at = r, i
            if best is None:
                return [self.rank[p] for p in parts]
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def fits(self, before: int, t: int) -> bool:
        """Whether two neighbouring tokens stay as they are when their bytes are merged together."""
        if len(self._fits) > CACHED_PAIRS:
            self._fits.clear()
        ok = self.merge(self.token[before] + self.token[t]) == [before, t]
        self._fits[before << self._bits | t] = ok
        return ok

    def extend(self, last: list[int], data: bytes, until: int | None = None) -> None:
        """Adds the last token of every prefix of `data` beyond those in `last`, up to `until` bytes.

        The automaton names the tokens that end at each byte; only tokens that merging gives back are in it.
        """
        n, known, bits = len(last), self._fits.get, self._bits
        base = max(0, n - self.longest)
        at = n - base
        for end, (t, size) in self._tokens.iter(data[base:until].decode("latin-1")):
            if end == at:
                start = n - size
                if start >= 0:
                    before = last[start]
                    ok = known(before << bits | t)
                    if ok is None:
                        ok = self.fits(before, t)
                else:
                    ok = start == -1
                if ok:
                    last.append(t)
                    n += 1
                    at += 1

    def read(self, last: list[int]) -> list[int]:
        """The encoding, read backwards from the last entry."""
        out, at = [], len(last)
        while at:
            out.append(last[at - 1])
            at -= len(self.token[out[-1]])
        return out[::-1]


class PrefixTable:
    """The last token of every prefix of some bytes, kept up to date under appends and edits."""

    def __init__(self, ranks: Ranks, data: bytes = b""):
        self.ranks, self.data, self.last = ranks, b"", []
        self.append(data)

    def append(self, more: bytes) -> None:
        self.data += more
        self.ranks.extend(self.last, self.data)

    def edit(self, start: int, end: int, new: bytes) -> int:
        """Replaces bytes start..end; returns how many entries were computed anew.

        An entry depends on as many entries and bytes before it as the longest token has; once that many
        behind the edit agree with the old table, the rest of it holds.
        """
        old, shift, far = self.last, len(new) - (end - start), self.ranks.longest
        self.data = self.data[:start] + new + self.data[end:]
        self.last, done = old[:start], start + len(new)
        self.ranks.extend(self.last, self.data, done)
        while done < len(self.data):
            step = min(done + far, len(self.data))
            self.ranks.extend(self.last, self.data, step)
            if step - done == far and self.last[done:step] == old[done - shift : step - shift]:
                self.last += old[step - shift :]
                return step - start
            done = step
        return len(self.data) - start

    def ids(self) -> list[int]:
        return self.ranks.read(self.last)


class Encoder:
    """Encodes texts piece by piece; pieces seen before are remembered up to a bound."""

    def __init__(self, path: str, pattern: str):
        self.ranks, self.find = Ranks(path), regex.compile(pattern).findall
        self.pieces: dict[str, bytes] = {}
        self.stems: dict[bytes, list[int]] = {}
        self.table = [self.ranks.token.get(i, b"") for i in range(max(self.ranks.token) + 1)]

    def ids(self, data: bytes) -> list[int]:
        """One piece's tokens. Its table starts from that of its first bytes if another piece had the same."""
        if data in self.ranks.rank:
            return [self.ranks.rank[data]]
        last = self.stems.get(data[:STEM], [])[:]
        self.ranks.extend(last, data)
        if len(self.stems) > CACHED_STEMS:
            self.stems.clear()
        if len(data) > STEM:
            self.stems[data[:STEM]] = last[:STEM]
        return self.ranks.read(last)

    def piece(self, text: str) -> bytes:
        ids = self.ids(text.encode())
        found = array("I", ids).tobytes()
        if len(text) <= LONG:
            if len(self.pieces) > CACHED_PIECES:
                self.pieces.clear()
            self.pieces[text] = found
        return found

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        get, piece = self.pieces.get, self.piece
        return b"".join([get(p) or piece(p) for p in self.find(text)])

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.table.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@lru_cache(maxsize=2)
def encoder(path: str, pattern: str) -> Encoder:
    return Encoder(path, pattern)


def encode(docs: DataFrame, path: str, pattern: str, *, digests: bool = False) -> DataFrame:
    """`docs` (doc_id, text) to (doc_id, ids binary, n_tokens), or with digests of ids and decoded bytes.

    A null text is empty: no tokens. Every row gives a row; other columns are ignored. Nothing is shuffled.
    """
    outs = ["doc_id long", "n_tokens long"]
    outs += ["ids_sha256 string", "decoded_sha256 string"] if digests else ["ids binary"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path, pattern)
        for batch in batches:
            ids = [enc.encode(x) for x in batch.column("text").to_pylist()]
            cols = [batch.column("doc_id"), pa.array([len(x) // 4 for x in ids], pa.int64())]
            if digests:
                cols.append(pa.array([hashlib.sha256(x).hexdigest() for x in ids], pa.string()))
                cols.append(pa.array([hashlib.sha256(enc.decode(x)).hexdigest() for x in ids], pa.string()))
            else:
                cols.append(pa.array(ids, pa.binary()))
            yield pa.RecordBatch.from_arrays(cols, [c.split()[0] for c in outs])

    ship(docs.sparkSession)
    text = F.coalesce(F.col("text"), F.lit("")).alias("text")
    return docs.select(F.col("doc_id").cast("long"), text).mapInArrow(run, ", ".join(outs))


def decode(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, ids) back to (doc_id, content binary); null ids give no bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path, pattern)
        for batch in batches:
            content = [enc.decode(x or b"") for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(content, pa.binary())], ["doc_id", "content"]
            )

    ship(encoded.sparkSession)
    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, content binary")


def op9_prefix_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document under byte_bpe_multi_50k, with digests of its ids and of the bytes decoded from them."""
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return encode(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN, digests=True)
