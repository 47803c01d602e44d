"""Token counts through a digest cache.

A cache table holds (tokenizer version, content digest, count). Counting a table digests every text in the
JVM, keeps one text per distinct digest, drops the digests that the cache knows, encodes only the rest and
appends their counts. Documents then get their counts by joining digests. No group of equal texts is ever
gathered: the distinct texts come from a partial aggregate, and the join has one cache row per digest.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers
from lonja.llm.common import ship, table
from lonja.workspace import espacio

CACHE_SCHEMA = "version string, digest binary, n_bytes long, n_tokens long"
BATCH = 256


def tokenizer_version(path: str, settings: str = "") -> str:
    """Digest of the vocabulary file and of the settings that change counts."""
    with open(path, "rb") as f:
        return hashlib.sha256(f.read() + settings.encode()).hexdigest()


def normalised(text: Column) -> Column:
    """The content that decides a count: the text as it is, null as empty."""
    return F.coalesce(text, F.lit(""))


def content_digest(text: Column) -> Column:
    return F.unhex(F.sha2(text.cast("binary"), 256))


@lru_cache(maxsize=2)
def _counter(path: str):
    """A function from texts to token counts for a .model (sentencepiece) or .json (tokenizers) file."""
    if path.endswith(".model"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda texts: [len(x) for x in model.encode(texts, num_threads=1)]
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(path)
    model.no_truncation()
    model.no_padding()
    return lambda texts: [len(model.encode(x, add_special_tokens=False).ids) for x in texts]


def encode_counts(texts: DataFrame, path: str, version: str) -> DataFrame:
    """Rows (digest, content) to cache rows; `path` is read on the executors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = _counter(path)
        for batch in batches:
            for start in range(0, batch.num_rows, BATCH):
                part = batch.slice(start, BATCH)
                contents = part.column("content").to_pylist()
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([version] * len(contents), pa.string()),
                        part.column("digest").cast(pa.binary()),
                        pa.array([len(x.encode()) for x in contents], pa.int64()),
                        pa.array(count(contents), pa.int64()),
                    ],
                    ["version", "digest", "n_bytes", "n_tokens"],
                )

    ship(texts.sparkSession)
    return texts.mapInArrow(run, CACHE_SCHEMA)


def count_tokens(docs: DataFrame, cache: str, path: str, *, settings: str = "") -> DataFrame:
    """`docs` (doc_id, text) with n_bytes and n_tokens; `cache` is a folder of cache rows that is appended to.

    Null counts as empty, special strings in a text are handled by the library's default. A cache that
    doesn't exist yet is empty. Every row of `docs` gives one row; a digest that two runs append at the
    same time is counted once.
    """
    spark = docs.sparkSession
    version = tokenizer_version(path, settings)
    rows = docs.select("doc_id", normalised(F.col("text")).alias("content"))
    keyed = rows.select("doc_id", content_digest(F.col("content")).alias("digest"), "content")
    spark.createDataFrame([], CACHE_SCHEMA).write.mode("append").parquet(cache)
    known = spark.read.schema(CACHE_SCHEMA).parquet(cache).where(F.col("version") == version)
    unknown = keyed.join(known.select("digest"), "digest", "left_anti")
    fresh = unknown.groupBy("digest").agg(F.first("content").alias("content"))
    encode_counts(fresh, path, version).write.mode("append").parquet(cache)
    known = spark.read.schema(CACHE_SCHEMA).parquet(cache).where(F.col("version") == version)
    counts = known.groupBy("digest").agg(F.max("n_bytes").alias("n_bytes"), F.max("n_tokens").alias("n_tokens"))
    return keyed.select("doc_id", "digest").join(counts, "digest").select("doc_id", "n_bytes", "n_tokens")


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document under piece_bpe_32k.model; `over_limit` is more than 4096.

    The cache starts empty here, in a new shared folder; a production run passes the folder it keeps.
    """
    path = public_tokenizers.path("piece_bpe_32k.model")
    counts = count_tokens(table(spark, sf_dir, "documents"), espacio(spark, "token-cache"), path)
    return counts.withColumn("over_limit", F.col("n_tokens") > 4096)
