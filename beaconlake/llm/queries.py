"""Named queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from beaconlake.llm import bpe, conversations, hard_negatives, html_text, jaccard, language, maxent, near_duplicates, packing, quality, repeats, token_files, topk
from beaconlake.llm.common import table

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.deduplicated(table(spark, sf_dir, "documents"), size=50).drop("kept")


def op2_maxent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maxent.scored(table(spark, sf_dir, "documents"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identified(table(spark, sf_dir, "documents"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judged(table(spark, sf_dir, "documents"))


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.round_trip(table(spark, sf_dir, "documents"), BYTE_BPE, end_id=0)


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), BYTE_BPE, end_id=2, size=1024)


def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extracted(table(spark, sf_dir, "pages"))


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_decode(table(spark, sf_dir, "documents"), WORD_BPE)


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.linked_documents(table(spark, sf_dir, "documents"), words=3, percent=90)


def op10_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(table(spark, sf_dir, "embeddings"), k=5, every=50, scale=256)


def op11_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.grouped(table(spark, sf_dir, "documents"), words=5, percent=85)


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.mined(table(spark, sf_dir, "embeddings"), every=100)


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.repaired(table(spark, sf_dir, "conversations"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_suffix_dedup, op2_maxent, op3_language_id, op4_quality_rules, op5_token_files, op6_packing, op7_html_text, op8_bpe,
        op9_jaccard_join, op10_topk, op11_near_duplicates, op12_hard_negatives, op13_conversation_repair,
    )
}
