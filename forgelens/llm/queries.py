"""Registered queries of the corpus operators: thin views on what they return."""

from __future__ import annotations

import zlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    alignment,
    ann,
    common,
    license_scan,
    mixing,
    near_dedup,
    periodic_runs,
    pieces,
    quality_rank,
    quality_rules,
    sharding,
    suffix_dedup,
    token_files,
    url_filter,
)


def op1_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    """20 nearest vectors found for every twentieth vec_id."""
    return ann.search_every(common.table(spark, sf_dir, "embeddings"), 20)


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Histogram divergence of every document from its language."""
    judged = quality_rules.judge(common.table(spark, sf_dir, "documents"))
    return judged.select(
        "row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 16 shards, scattered by key and shuffled; digests of the written rows."""
    written = sharding.sharded(common.table(spark, sf_dir, "documents").select("doc_id", "text"))
    text = F.coalesce(F.col("row.text"), F.lit(""))
    return written.select(
        "row.doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("key").alias("law"),
        "shard",
        "slot",
        "grown_shard",
    )


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of all documents, their parity with SentencePiece and their round trip."""
    return pieces.encode(common.table(spark, sf_dir, "documents"))


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What all documents share with a document of a smaller id, cut at 50 bytes."""
    cut = suffix_dedup.shared_strings(common.table(spark, sf_dir, "documents"))
    return cut.select("row.doc_id", "n_bytes", *suffix_dedup.digests(cut))


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bradley-Terry scores of all documents, learned outside the held-out fold."""
    documents = common.table(spark, sf_dir, "documents")
    return quality_rank.score(documents, quality_rank.learn(documents, common.table(spark, sf_dir, "labels")))


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules and character models over all page addresses."""
    return url_filter.judge(common.table(spark, sf_dir, "pages")).drop("score")


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed to the weights of their sources."""
    planned = mixing.plan_mix(common.table(spark, sf_dir, "documents"))
    taken = (F.col("size") * F.col("copies")).alias("taken")
    return planned.select("doc_id", "size", "source_size", "target", taken, "copies")


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and template matches in all documents."""
    return license_scan.scan(common.table(spark, sf_dir, "documents")).drop("matches")


def op10_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of all documents whose sets of four-word shingles are similar."""
    return near_dedup.link_components(common.table(spark, sf_dir, "documents"), size=4)


def repeated_tail(doc_id: int | None, n_words: int) -> tuple[int, int] | None:
    """Where every tenth document, by the checksum of its id, gets a periodic end: first word and period."""
    if doc_id is None or not n_words:
        return None
    tens, digit = divmod(zlib.crc32(str(doc_id).encode()), 10)
    start = tens % n_words
    return (start, 1 + (n_words - start) // (3 + tens % 8)) if digit == 0 else None


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of words in all documents, of which some get a periodic end first."""
    documents = common.table(spark, sf_dir, "documents")
    return periodic_runs.digests(periodic_runs.runs(documents, repeated_tail))


def op12_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of all documents written as binary shards, and what a reader finds in them."""
    documents = common.table(spark, sf_dir, "documents")
    return token_files.read(token_files.write(documents, common.scratch_dir(spark, "token-files")))


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of two vocabularies aligned over all documents, with corpus-wide counts of linked ids."""
    return alignment.measured(alignment.align(common.table(spark, sf_dir, "documents")))


QUERIES = {
    "op1_ann": op1_ann,
    "op2_quality_rules": op2_quality_rules,
    "op3_sharding": op3_sharding,
    "op4_sentencepiece": op4_sentencepiece,
    "op5_suffix_dedup": op5_suffix_dedup,
    "op6_quality_classifier": op6_quality_classifier,
    "op7_url_filter": op7_url_filter,
    "op8_mixing": op8_mixing,
    "op9_license_scan": op9_license_scan,
    "op10_near_dedup": op10_near_dedup,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_token_files": op12_token_files,
    "op13_alignment": op13_alignment,
}


def queries():
    return {name: (lambda spark, sf_dir, q=query: q(common.ready(spark), sf_dir)) for name, query in QUERIES.items()}
