"""A corpus from ``documents`` in five stages, each an operator of the corpus
subpackage.  A stage's result is written as Parquet and read again by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import byte_bpe, exact_dedup, mixing, quality, simhash
from tidemark.llm.common import materialise
from tidemark.llm.queries import VOCABULARY
from tidemark.sources.tables import table

SHINGLE_WORDS = 3
MAX_BITS = 2


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier scores 0.5 or more."""
    weights = quality.learn_weights(docs, table(spark, sf_dir, "labels"))
    return quality.keep_good(docs, weights)


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup.keep_first_copies(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near copies."""
    return simhash.keep_first_of_groups(docs, SHINGLE_WORDS, MAX_BITS)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents taken for the target weights of sources."""
    return mixing.mixed_documents(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and digests of the token ids and the decoded text."""
    import public_tokenizers

    return byte_bpe.encode_documents(docs, public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN)


STAGES = [
    ("quality_classifier", good_documents),
    ("exact_dedup", without_copies),
    ("simhash_near_dedup", without_near_copies),
    ("mixing", mixed),
    ("byte_bpe", encoded),
]

#: The classifier, the fingerprints and the encoding are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = materialise(docs, f"pipeline-{name}")
    return docs
