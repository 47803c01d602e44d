"""Corpus pipeline over `documents`: quality classifier, near-dedup, substring dedup, packing.

Every stage reads what the one before kept, as a Parquet table. All but the last keep the columns of
`documents`; further columns are passed on. Nulls, empty texts, repeated rows and empty tables are handled as
the operators' docstrings say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

import public_tokenizers
from lonja.llm.bbit_minhash import one_of_each
from lonja.llm.bm25_packing import pack
from lonja.llm.common import table, written
from lonja.llm.cotraining import score, train
from lonja.llm.lempel_ziv import cut_copies


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier keeps; it learns from `labels` of the stage's own input."""
    model = train(docs, table(spark, sf_dir, "labels"))
    return score(docs, model).where("kept").select("row.*")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest doc_id, of each group linked by 5-word shingles at 0.8."""
    return one_of_each(docs, shingle=5, percent=80)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the words of 20-word windows that start earlier."""
    return cut_copies(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of 2048 ids."""
    return pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality classifier", quality),
    ("MinHash near-dedup", near_dedup),
    ("substring dedup", substring_dedup),
    ("packing", packing),
]

# The classifier's weights come from an iterative fit, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
