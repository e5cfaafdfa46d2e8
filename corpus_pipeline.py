"""A corpus pipeline over ``documents``: each stage calls one operator of ``beaconlake.llm`` on all rows its predecessor kept.

Defined cases: every stage but the last returns the columns it was given, whatever others there are beside doc_id, text and
lang. Rows without a text or a letter have no language and go in the first stage. A null doc_id is larger than all others; rows
that share an id, or lack one, are rows of their own. Repeated rows are copies: one stays. Texts are read whole, however
long. An empty table, or one of which nothing is kept, gives no pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from beaconlake.llm import jaccard, language, packing, quality, repeats
from beaconlake.llm.common import bounded_batches, table
from beaconlake.llm.queries import BYTE_BPE
from beaconlake.session import written


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised."""
    bounded_batches(spark)
    return language.kept_documents(docs)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weighed rules judge good."""
    return quality.kept_documents(docs)


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group joined by similar sets of five-word shingles."""
    return jaccard.kept_documents(docs, words=5, percent=80)


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without strings of 50 bytes or more that one of smaller id has too."""
    return repeats.kept_documents(docs, size=50)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every document, placed in sequences of at most 1024 ids."""
    return packing.pack(docs, BYTE_BPE, end_id=2, size=1024)


STAGES = [
    ("language ID", language_id),
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", jaccard_join),
    ("suffix-array dedup", suffix_dedup),
    ("best-fit packing", best_fit_packing),
]

#: Byte contexts, EM, tokenisation and pattern fitting have no SQL form; a test holds the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-").lower())
    return STAGES[-1][1](spark, docs, sf_dir)
