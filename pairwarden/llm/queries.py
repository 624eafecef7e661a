"""Registered queries opN_* over the test tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairwarden.llm import sql
from pairwarden.llm.decontamination import mark_contamination
from pairwarden.llm.divergence import divergence_audit
from pairwarden.llm.exact_dedup import exact_duplicates
from pairwarden.llm.language_id import held_out, identify
from pairwarden.llm.line_dedup import drop_repeated_lines
from pairwarden.llm.manifest import merkle_manifest
from pairwarden.llm.nearest import nearest_by_product
from pairwarden.llm.packing import pack_powers
from pairwarden.llm.shipping import prepare
from pairwarden.llm.simhash_dedup import near_duplicates
from pairwarden.llm.substring_dedup import remove_repeats
from pairwarden.llm.suffix_dedup import remove_long_repeats
from pairwarden.llm.token_counts import context_totals, encoded_lengths, length_histogram
from pairwarden.llm.toxicity import score_toxicity
from pairwarden.session import stage

Query = Callable[[SparkSession, str], DataFrame]


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_long_repeats(documents(spark, sf_dir), window=50, with_text=False)


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_repeated_lines(documents(spark, sf_dir), min_docs=10, min_chars=1, with_text=False)


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_powers(documents(spark, sf_dir), longest=2048, end_id=1)


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text", "lang", held_out("doc_id", 5, 0).alias("held_out"))
    found = identify(docs.drop("lang"), docs.filter(~F.col("held_out")))
    return found.select("doc_id", "held_out", *[f"language.{c}" for c in ("lang_pred", "score", "rejected")])


def op5_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir), shingle=3, max_distance=3)


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(documents(spark, sf_dir))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    lengths = encoded_lengths(documents(spark, sf_dir))
    return context_totals(stage(length_histogram(lengths), "lengths"))  # read twice


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scored = score_toxicity(documents(spark, sf_dir), labels, held_out("doc_id", 3, 1), threshold=0.7)
    return scored.drop("votes")


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(documents(spark, sf_dir), window=13, with_text=False)


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return mark_contamination(docs, benchmark).select(
        "doc_id", *[f"contamination.{c}" for c in ("n_words", "n_hit", "n_items", "items_sha256", "contaminated")]
    )


def op11_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return nearest_by_product(vectors, F.col("vec_id") % 20 == 0, k=20)


def op12_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    tampered = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    return merkle_manifest(documents(spark, sf_dir), tampered).drop("lang", "idx")


def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence_audit(documents(spark, sf_dir), min_docs=30, top=50)


QUERIES: dict[str, Query] = {
    "op1_suffix_dedup": op1_suffix_dedup,
    "op2_line_dedup": op2_line_dedup,
    "op3_packing": op3_packing,
    "op4_language_id": op4_language_id,
    "op5_simhash_dedup": op5_simhash_dedup,
    "op6_exact_dedup": op6_exact_dedup,
    "op7_token_counts": op7_token_counts,
    "op8_toxicity": op8_toxicity,
    "op9_substring_dedup": op9_substring_dedup,
    "op10_decontamination": op10_decontamination,
    "op11_nearest": op11_nearest,
    "op12_manifest": op12_manifest,
    "op13_divergence": op13_divergence,
}

ORACLES: dict[str, str] = {
    "op1_suffix_dedup": sql.OP1,
    "op2_line_dedup": sql.OP2,
    "op6_exact_dedup": sql.OP6,
    "op9_substring_dedup": sql.OP9,
    "op10_decontamination": sql.OP10,
    "op12_manifest": sql.OP12,
    "op13_divergence": sql.OP13,
}
