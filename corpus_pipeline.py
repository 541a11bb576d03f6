"""A training corpus from ``documents``: five operators in sequence, each written and read again."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from smeltery.llm import apportion, bpe, cotraining, line_dedup, simhash
from smeltery.llm.shared import load, stored

RANKS = "byte_bpe_multi_50k.tiktoken"


def _recounted(docs: DataFrame) -> DataFrame:
    """``n_chars`` as the text is now."""
    if "n_chars" not in docs.columns:
        return docs
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the quality classifier rejects."""
    return cotraining.keep_good(docs, load(spark, sf_dir, "labels"))


def own_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document without the lines that belong to others."""
    return _recounted(line_dedup.without_shared_lines(docs))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: shingles of 3 words, at most 2 bits apart."""
    return simhash.keep_one(docs, shingle=3, max_bits=2)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents in the proportions of the mix, repeated or cut to blocks where it says so."""
    return _recounted(apportion.mixed_documents(docs))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with digests of ids and decoded bytes."""
    return bpe.encode(docs, bpe.read_ranks(public_tokenizers.path(RANKS)))


STAGES = [
    ("quality classifier", good_documents),
    ("line dedup", own_lines),
    ("near duplicates", one_of_each),
    ("mixing sources", mixed),
    ("encoding", encoded),
]

# Hashes, a fitted model and a tokenizer are beyond SQL; the stages are tested one by one.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
