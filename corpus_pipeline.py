"""From raw documents to token ids: five stages, each kept as a table and read by the next.

Every stage takes all documents that its predecessor kept and returns the columns of
``documents``; the last returns one row of token digests per document.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from lakeconform.llm import bpe, decontaminate, importance, line_dedup, ngram_join
from lakeconform.llm.common import stored, table

# No SQL: hashed models, set-similarity joins and byte-level BPE. Tests compare the stages with
# brute force instead.
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the importance sample keeps; toxic and poor ones go."""
    return importance.sampled(docs, table(spark, sf_dir, "labels"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without lines that repeat an earlier one; documents left without words go."""
    return line_dedup.deduplicated(docs)


def alike(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that is alike in five-word shingles."""
    return ngram_join.keep_one(docs, width=5, percent=80)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of what is left."""
    return bpe.encode_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality classifier", quality),
    ("line dedup", lines),
    ("n-gram Jaccard join", alike),
    ("benchmark decontamination", benchmark),
    ("BPE encoding and decoding", tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{i}")
    return docs
