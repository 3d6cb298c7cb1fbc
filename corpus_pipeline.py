"""The corpus pipeline: stages that clean ``documents`` and end in token ids.

Each stage works on all that its predecessor kept. The first four return the columns of their
input; the last returns a row of token ids per document. A row is judged by its own text: rows that
share an id, or have none, do not take each other along. Empty tables pass, and so do other columns.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lendlens.llm import block_naming, bpe, decontaminate, language_id, simhash
from lendlens.llm.common import stored, table

VOCABULARY = "byte_bpe_multi_50k.tiktoken"


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents that language ID rejects."""
    return language_id.drop_unknown(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each text, that with the largest id."""
    return block_naming.drop_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group, that with the smallest id."""
    return simhash.drop_near_copies(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents that hold a benchmark item, also with other values."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, n_tokens, ids`` and the digest of the text decoded from the ids."""
    ranks = bpe.read_ranks(public_tokenizers.path(VOCABULARY))
    decoded = bpe.round_trip(docs, ranks, public_tokenizers.PATTERN)
    return decoded.select("doc_id", "n_tokens", "ids", F.sha2("bytes", 256).alias("decoded_sha256"))


STAGES = [
    ("language ID", known_language),
    ("exact dedup", exact_dedup),
    ("SimHash near-dedup", near_dedup),
    ("benchmark decontamination", without_benchmark),
    ("byte-level BPE", tokenize),
]
ORACLE_SQL = None  # models, fingerprints and merges have no SQL form; tests/llm has a brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each reads the stored result of the one before."""
    docs = table(spark, sf_dir, "documents")
    for position, (_, stage) in enumerate(STAGES):
        docs = stored(stage(spark, docs, sf_dir), f"stage-{position}")
    return docs
