"""One query per operator, over its whole table with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from sluiceway.llm import (
    decontaminate,
    language,
    license_scan,
    line_chunks,
    order_minhash,
    packing,
    periodic_runs,
    permutation_index,
    pii,
    spelling_variants,
    suffix_dedup,
    token_files,
    toxicity,
)
from sluiceway.llm.common import table


def op2_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest found of every hundredth vector."""
    return permutation_index.nearest(
        table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0
    )


def tokenizer_path(name: str) -> str:
    """File of a public tokenizer; executors have the same installation."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each document loses as repeated multi-line chunks."""
    return line_chunks.report(table(spark, sf_dir, "documents"))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents in windows of 2048 ids."""
    docs = table(spark, sf_dir, "documents")
    return packing.pack(docs, tokenizer_path("byte_bpe_50k.json"))


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the token files of all documents hold, read back."""
    docs = table(spark, sf_dir, "documents")
    return token_files.round_trip(docs, tokenizer_path("word_bpe_49k.json"))


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each document loses as byte strings of 400 that occur again."""
    return suffix_dedup.kept(table(spark, sf_dir, "documents"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document by word-first backoff."""
    return language.identify(table(spark, sf_dir, "documents"))


def op7_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document."""
    return pii.find(table(spark, sf_dir, "documents"))


def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class of near copies of every document."""
    return order_minhash.classes(table(spark, sf_dir, "documents"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document after deobfuscation."""
    return toxicity.detect(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold test items, with the score of the alignment."""
    return decontaminate.contaminated(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near words, form and root of every word in use."""
    return spelling_variants.variants(table(spark, sf_dir, "documents"))


def op12_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licenses that every document names or holds passages of."""
    return license_scan.scan(table(spark, sf_dir, "documents"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of words of every document."""
    return periodic_runs.report(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_line_dedup": op1_line_dedup,
    "op2_nearest_neighbours": op2_nearest_neighbours,
    "op3_packing": op3_packing,
    "op4_token_files": op4_token_files,
    "op5_suffix_dedup": op5_suffix_dedup,
    "op6_language_id": op6_language_id,
    "op7_personal_data": op7_personal_data,
    "op8_near_duplicates": op8_near_duplicates,
    "op9_toxicity": op9_toxicity,
    "op10_decontamination": op10_decontamination,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_license_scan": op12_license_scan,
    "op13_periodic_runs": op13_periodic_runs,
}
SQL: dict[str, str] = {}
