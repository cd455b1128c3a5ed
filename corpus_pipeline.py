"""A training corpus in five stages: quality rules, near copies, benchmark leaks, secrets, tokens.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; its result is written as Parquet
and read again as the next stage's documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillworks.llm import bpe_lexicon, dart_minhash, quality_rules, secret_scan, template_leaks
from tillworks.llm.common import shared_file, stored, table

#: Pieces whose ids a task of the last stage remembers. Its workers serve the other stages, too.
REMEMBERED = 100_000


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality_rules.keep_good(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: that with the smallest doc_id."""
    return dart_minhash.one_of_each(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, re-parameterised or not, go."""
    return template_leaks.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in the texts are replaced by a mark; all documents stay."""
    return secret_scan.without_secrets(docs).withColumn("n_chars", F.length("text").cast("long"))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document in place of its text, and the hash of what they decode to."""
    vocabulary, lexicon = public_tokenizers.path("word_bpe_49k.json"), shared_file(spark, "lexicon")
    bpe_lexicon.build_lexicon(docs, vocabulary, lexicon)
    coded = bpe_lexicon.encode(docs, vocabulary, lexicon, remembered=REMEMBERED, lasting=False)
    return coded.select(
        "doc_id", "lang", "source", "n_chars", F.size("ids").cast("long").alias("n_tokens"), "ids",
        F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("quality rules", good_quality),
    ("MinHash near-dedup", without_near_copies),
    ("benchmark decontamination", without_benchmark),
    ("secret scans", without_secrets),
    ("BPE encoding and decoding", encoded),
]

#: Expectation-maximisation and the later stages have no SQL form; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
