"""The corpus pipeline: five stages over ``documents``, each written and read again.

Language ID rejects documents without a letter or whose known words tell no language. Line dedup
cuts out multi-line chunks that stood in an earlier document and drops documents of which
nothing is left. Near-dedup keeps one document of each class of near copies. Decontamination
drops documents that hold a test item. Packing, the last stage, gives the pieces of the
packed sequences; all others return the columns of ``documents``.

An empty table passes all stages and gives no piece. Extra columns are carried to the last
stage. What a stage does with nulls and repeated rows is stated where its operator is.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sluiceway.llm import decontaminate, language, line_chunks, order_minhash, packing
from sluiceway.llm.common import stage, table
from sluiceway.llm.queries import tokenizer_path


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known."""
    return language.keep_identified(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the chunks that an earlier one has."""
    return line_chunks.deduplicate(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies."""
    return order_minhash.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no test item."""
    return decontaminate.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the packed sequences."""
    return packing.pack(docs, tokenizer_path("byte_bpe_50k.json"))


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), name)
    return docs


# Language models, hashes chosen by content and tokenizers have no SQL; the stages are tested
# against brute force.
ORACLE_SQL = None
