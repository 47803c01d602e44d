"""Token ids as flat files of unsigned integers with 64-bit document offsets.

A folder holds parts in ascending doc_id order. Each part is three flat little-endian files: `.ids`, the ids of its
documents in a row, in the narrowest unsigned type that holds the vocabulary; `.offsets`, where each document begins
in them and the last ends, 64 bits each; and `.docs`, the doc_ids, 64 bits each, of which the first `nulls` stand
for null. `manifest.json` lists the parts in order. A part's base, the number of ids in all parts before it, is a
prefix sum over the parts' totals, so no task waits for another and nothing is written twice. `TokenFiles` maps the
files into memory and reads any stretch of the whole or any document without touching the rest.

Rows are sorted by (doc_id, digest of the text, row number), so that not even one doc_id or one document that a
third of all rows share is bound to one part. A task writes under a name of its own and reports it as a row; only
names from Spark's committed rows get into the manifest, so attempts that failed or ran twice leave no trace.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from functools import cached_property
from itertools import pairwise
from uuid import uuid4

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers
from lonja.llm.common import partitions, ship, table, written
from lonja.llm.word_ids import slices, word_ids
from lonja.workspace import espacio

END_ID = 2
SLICE_BYTES, READ_IDS = 6_000_000, 4_000_000
SUFFIXES = ("ids", "offsets", "docs")
PART = "part int, name string, n_docs long, n_ids long, nulls long"
ROW = "doc_id long, start long, n_tokens long, ids_crc32 long"


def file_system(folder: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """The file system of a path or URI that every executor sees, and the path in it."""
    return pyarrow.fs.FileSystem.from_uri(folder)


class PartWriter:
    """Writes one part document by document; nothing is held but the offsets."""

    def __init__(self, folder: str, number: int, kind: str):
        self.fs, path = file_system(folder)
        self.name, self.kind, self.number = f"part-{number:06d}-{uuid4().hex}", kind, number
        self.files = [self.fs.open_output_stream(f"{path}/{self.name}.{s}") for s in SUFFIXES]
        self.n_docs = self.n_ids = self.nulls = 0
        self.files[1].write(np.zeros(1, "<u8").tobytes())

    def add(self, doc_ids: pa.Array, ids: np.ndarray, at: np.ndarray) -> None:
        """Documents with all their ids; `at`: where each begins in `ids` and the last ends."""
        self.files[0].write(np.ascontiguousarray(ids, self.kind).tobytes())
        self.files[1].write((at[1:] + self.n_ids).astype("<u8").tobytes())
        self.files[2].write(doc_ids.fill_null(0).to_numpy(zero_copy_only=False).astype("<i8").tobytes())
        self.n_docs, self.n_ids, self.nulls = self.n_docs + len(doc_ids), self.n_ids + len(ids), self.nulls + doc_ids.null_count

    def close(self) -> pa.RecordBatch:
        for f in self.files:
            f.close()
        return pa.RecordBatch.from_pylist(
            [{"part": self.number, "name": self.name, "n_docs": self.n_docs, "n_ids": self.n_ids, "nulls": self.nulls}],
            pa.schema([("part", pa.int32()), ("name", pa.string()), *[(c, pa.int64()) for c in ("n_docs", "n_ids", "nulls")]]),
        )


class TokenPart:
    """One part, mapped into memory; on a file system that can't be mapped, read where asked."""

    def __init__(self, folder: str, part: dict, kind: str):
        fs, path = file_system(folder)
        self.n_docs, self.n_ids, self.nulls, self.base = (part[c] for c in ("n_docs", "n_ids", "nulls", "base"))
        local = isinstance(fs, pyarrow.fs.LocalFileSystem)
        names = [f"{path}/{part['name']}.{s}" for s in SUFFIXES]
        self.files = [pa.memory_map(n) if local else fs.open_input_file(n) for n in names]
        self.kinds = [kind, "<u8", "<i8"]

    def _read(self, file: int, start: int, n: int) -> np.ndarray:
        """`n` entries of a file; a view of the mapped pages, not a copy, where the file is mapped."""
        if not n:
            return np.zeros(0, self.kinds[file])
        width = np.dtype(self.kinds[file]).itemsize
        self.files[file].seek(start * width)
        return np.frombuffer(self.files[file].read_buffer(n * width), self.kinds[file])

    def ids(self, start: int, n: int) -> np.ndarray:
        return self._read(0, start, n)

    def offsets(self, first: int, n: int) -> np.ndarray:
        return self._read(1, first, n).astype(np.int64)

    def doc_ids(self, first: int, n: int) -> list[int | None]:
        found = self._read(2, first, n).tolist()
        return [None if first + i < self.nulls else x for i, x in enumerate(found)]

    def close(self) -> None:
        for f in self.files:
            f.close()


class TokenFiles:
    """Random access to a folder of token files: the document or the ids at any place of the whole."""

    def __init__(self, folder: str):
        fs, path = file_system(folder)
        self.folder = folder
        with fs.open_input_stream(f"{path}/manifest.json") as f:
            found = json.loads(f.read())
        self.kind, self.parts = found["kind"], found["parts"]
        self.n_docs, self.n_ids = (sum(p[c] for p in self.parts) for c in ("n_docs", "n_ids"))
        self._open: dict[int, TokenPart] = {}

    @cached_property
    def _firsts(self) -> tuple[np.ndarray, np.ndarray]:
        docs = np.cumsum([0] + [p["n_docs"] for p in self.parts])
        return docs[:-1], np.array([p["base"] for p in self.parts], np.int64)

    def part(self, number: int) -> TokenPart:
        if number not in self._open:
            self._open[number] = TokenPart(self.folder, self.parts[number], self.kind)
        return self._open[number]

    def document(self, place: int) -> tuple[int | None, int, np.ndarray]:
        """(doc_id, start, ids) of the document at a place in doc_id order."""
        if not 0 <= place < self.n_docs:
            raise IndexError(place)
        docs, _ = self._firsts
        number = int(np.searchsorted(docs, place, "right")) - 1
        part, at = self.part(number), int(place - docs[number])
        lo, hi = part.offsets(at, 2).tolist()
        return part.doc_ids(at, 1)[0], part.base + lo, part.ids(lo, hi - lo)

    def ids(self, start: int, n: int) -> np.ndarray:
        """Up to `n` ids of the whole from `start` on, across documents and parts."""
        _, bases = self._firsts
        found = [np.zeros(0, self.kind)]
        number = int(np.searchsorted(bases, start, "right")) - 1
        while n > 0 and 0 <= number < len(self.parts):
            part = self.part(number)
            lo = start - part.base
            found.append(part.ids(lo, max(0, min(n, part.n_ids - lo))))
            start, n, number = start + len(found[-1]), n - len(found[-1]), number + 1
        return np.concatenate(found)


def with_bases(parts: list[dict]) -> list[dict]:
    """Parts in order, each with the number of ids before it."""
    parts = sorted(parts, key=lambda p: p["part"])
    bases = np.cumsum([0] + [p["n_ids"] for p in parts]).tolist()
    return [{**p, "base": b} for p, b in zip(parts, bases, strict=False)]


def write_token_files(docs: DataFrame, folder: str, path: str, *, end_id: int = END_ID) -> list[dict]:
    """Encodes `docs` (doc_id, text) with the tokenizer at `path`, ends each document by `end_id`, and writes `folder`.

    Null and empty texts are `end_id` alone. Null doc_ids come first; rows with equal doc_id are documents of their
    own, ordered by their texts' digests, and equal rows lie next to each other. Other columns are ignored. A table
    without rows gives a folder without parts. The driver gets one row per part.
    """
    spark = docs.sparkSession
    ship(spark)
    fs, place = file_system(folder)
    fs.create_dir(place, recursive=True)
    encoder = word_ids(path)
    kind = encoder.kind if max(encoder.vocabulary, end_id + 1) <= 1 << 8 * int(encoder.kind[-1]) else "<u4"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, out = word_ids(path).encode, None
        for batch in batches:
            texts = batch.column("text")
            for lo, n in slices(texts, SLICE_BYTES):
                out = out or PartWriter(folder, batch.column("part")[0].as_py(), kind)
                ids, at = encode(texts.slice(lo, n))
                out.add(batch.column("doc_id").slice(lo, n), np.insert(ids.astype(kind), at[1:], end_id), at + np.arange(n + 1))
        if out:
            yield out.close()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumns({"digest": F.xxhash64("text"), "row": F.monotonically_increasing_id()})
    order = ["doc_id", "digest", "row"]
    dealt = rows.repartitionByRange(partitions(spark), *order).sortWithinPartitions(*order)
    made = dealt.select(F.spark_partition_id().alias("part"), "doc_id", "text").mapInArrow(run, PART)
    parts = with_bases([r.asDict() for r in written(made, "token-parts").collect()])
    names = {f"{p['name']}.{s}" for p in parts for s in SUFFIXES}
    for found in fs.get_file_info(pyarrow.fs.FileSelector(place)):
        if found.base_name.startswith("part-") and found.base_name not in names:
            fs.delete_file(found.path)
    with fs.open_output_stream(f"{place}/manifest.json") as f:
        f.write(json.dumps({"kind": kind, "parts": parts}).encode())
    return parts


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """One row per document of a folder: doc_id, start, n_tokens, ids_crc32, computed from the mapped files.

    Each part is read by one task, some millions of ids at a time.
    """
    ship(spark)
    files = TokenFiles(folder)
    kind = files.kind

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                part = TokenPart(folder, row, kind)
                first = 0
                while first < part.n_docs:
                    at = part.offsets(first, min(1 << 16, part.n_docs - first) + 1)
                    n = max(1, int(np.searchsorted(at, at[0] + READ_IDS, "right")) - 1)
                    at = at[: n + 1]
                    ids = part.ids(int(at[0]), int(at[-1] - at[0])).astype("<u4")
                    crcs = [zlib.crc32(ids[a:b]) for a, b in pairwise((at - at[0]).tolist())]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(part.doc_ids(first, n), pa.int64()),
                            pa.array(at[:-1] + part.base),
                            pa.array(np.diff(at)),
                            pa.array(crcs, pa.int64()),
                        ],
                        [c.split()[0] for c in ROW.split(", ")],
                    )
                    first += n
                part.close()

    rows = [tuple(p[c.split()[0]] for c in PART.split(", ")) + (p["base"],) for p in files.parts]
    parts = spark.createDataFrame(rows, PART + ", base long")
    return parts.repartitionByRange(max(1, len(rows)), "part").mapInArrow(run, ROW)


def op11_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as ids of word_bpe_49k in token files, and what the files say of each."""
    folder = espacio(spark, "token-files")
    write_token_files(table(spark, sf_dir, "documents"), folder, public_tokenizers.path("word_bpe_49k.json"))
    return read_token_files(spark, folder)
