"""One query per operator: its production parameters, over the whole of its table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from starmill.llm import (
    bpe, chat_format, exact_dedup, html_extract, language_id, packing, prefix_trie,
    quality_classifier, quality_rules, secret_scan, simhash, token_counts, turn_repair,
)
from starmill.llm.common import table
from starmill.llm.oracle import ORACLE


def tokenizer_file(name: str = "byte_bpe_50k.json") -> str:
    """Where this machine has a public vocabulary; by default the byte-level one."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality_rules.quality_rules(table(spark, folder, "documents"))


def op2_language_id(spark: SparkSession, folder: str) -> DataFrame:
    return language_id.identify(table(spark, folder, "documents"))


def op3_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, folder, "documents"))


def op4_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    return quality_classifier.score_quality(
        table(spark, folder, "documents"), table(spark, folder, "labels")
    )


def op5_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    return secret_scan.scan(table(spark, folder, "documents"))


def op6_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.digests(table(spark, folder, "documents"), tokenizer_file())


def op7_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.decisions(table(spark, folder, "documents")).drop("file", "row")


def op8_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    return chat_format.format_chats(table(spark, folder, "conversations"))


def op9_html_extract(spark: SparkSession, folder: str) -> DataFrame:
    return html_extract.extract(table(spark, folder, "pages"))


def op10_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"), tokenizer_file())


def op11_turn_repair(spark: SparkSession, folder: str) -> DataFrame:
    return turn_repair.damaged_repairs(table(spark, folder, "conversations"))


def op12_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_trie.trie(table(spark, folder, "conversations"))


def op13_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.token_counts(
        table(spark, folder, "documents"), tokenizer_file("word_bpe_49k.json")
    )


_QUERIES = (
    op1_quality_rules, op2_language_id, op3_simhash, op4_quality_classifier, op5_secret_scan,
    op6_bpe, op7_exact_dedup, op8_chat_format, op9_html_extract, op10_packing,
    op11_turn_repair, op12_prefix_trie, op13_token_counts,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in _QUERIES}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
