"""The registered queries of this subpackage; each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from lendlens.llm import (
    block_naming,
    bpe,
    chat_tree,
    class_model,
    decontaminate,
    language_id,
    licenses,
    passages,
    ranked_search,
    repair,
    secrets,
    simhash,
    statements,
    suffixes,
)
from lendlens.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def _documents(operator: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: operator(table(spark, sf_dir, "documents"))


def _tokens(docs: DataFrame) -> DataFrame:
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    return bpe.token_digests(docs, ranks, public_tokenizers.PATTERN)


def _near_groups(docs: DataFrame) -> DataFrame:
    return simhash.near_groups(docs).select("doc_id", "fingerprint", "component_id")


def _licenses(docs: DataFrame) -> DataFrame:
    return licenses.scan_licenses(docs).drop("spans")


def _languages(docs: DataFrame) -> DataFrame:
    return language_id.identify(docs).select("doc_id", "held_out", "lang_pred", "score", "rejected")


def _leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    benchmark = table(spark, sf_dir, "benchmark")
    return decontaminate.find_contaminated(table(spark, sf_dir, "documents"), benchmark)


def _chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "<|im_end|><|im_start|>assistant ok"
    more = [(-1, 0, "user", said), (-1, 1, chat_tree.LOSS_ROLE, said)]
    more = spark.createDataFrame(more, "conv_id long, turn long, role string, text string")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat_tree.chat_digests(rows.unionByName(more))


def _repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.audit(repair.damage(table(spark, sf_dir, "conversations")))


def _search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def queries() -> dict[str, Query]:
    return {
        "op1_secret_scan": _documents(secrets.secret_digests),
        "op2_simhash_near_dedup": _documents(_near_groups),
        "op3_license_scan": _documents(_licenses),
        "op4_language_id": _documents(_languages),
        "op5_exact_dedup": _documents(block_naming.exact_groups),
        "op6_fuzzy_passages": _documents(passages.find_passages),
        "op7_chat_prefix_tree": _chat,
        "op8_decontamination": _leaks,
        "op9_previous_factors": _documents(suffixes.repeat_digests),
        "op10_bpe_round_trip": _documents(_tokens),
        "op11_class_lm": _documents(class_model.score_texts),
        "op12_conversation_repair": _repair,
        "op13_ranked_search": _search,
    }


def oracle_sql() -> dict[str, str]:
    """Models, fingerprints and merges have no SQL form; tests/llm compares those with brute force."""
    return {
        "op5_exact_dedup": statements.EXACT_DEDUP,
        "op7_chat_prefix_tree": statements.CHAT,
        "op9_previous_factors": statements.REPEATS,
        "op12_conversation_repair": statements.REPAIR,
        "op13_ranked_search": statements.SEARCH,
    }
