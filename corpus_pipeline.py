"""The corpus pipeline: stages that each read what the stage before has kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from forgelens.llm import common, mixing, near_dedup, pieces, quality_rules, suffix_dedup


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    common.ready(spark)
    return common.as_documents(quality_rules.keep_good(common.as_documents(docs)))


def deduplicated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (shingles of five words)."""
    common.ready(spark)
    return common.as_documents(near_dedup.keep_one(common.as_documents(docs), size=5))


def cut(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that a document of a smaller id holds too."""
    common.ready(spark)
    return common.as_documents(suffix_dedup.cut_repeats(common.as_documents(docs)))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the weights of their sources ask for."""
    common.ready(spark)
    return common.as_documents(mixing.mix(common.as_documents(docs)))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, held against SentencePiece's own."""
    common.ready(spark)
    return pieces.encode(common.as_documents(docs))


STAGES = [
    ("quality rules", quality),
    ("MinHash near-dedup", deduplicated),
    ("suffix-array dedup", cut),
    ("mixing sources to target weights", mixed),
    ("SentencePiece encoding and decoding", encoded),
]

# The last stage returns token ids of a public vocabulary, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are stored and read again."""
    docs = common.table(common.ready(spark), sf_dir, "documents")
    for place, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if place < len(STAGES) - 1:
            docs = common.stored(docs, f"stage-{place}")
    return docs
