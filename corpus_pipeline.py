"""Corpus pipeline: language ID, exact and near de-duplication, decontamination, packing.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept, and all but
the last return the columns of documents. ``run`` writes each stage's rows to the shared
folder and reads them again, so no stage depends on executors that ran an earlier one.

Rows with a null or empty text, or without a letter, are rejected by language ID; a null id, language
or source rejects nothing. Rows that share an id are rows of their own until a stage finds their
texts equal or near. Ties keep what each stage's docstring says. An empty table stays empty in every stage.
Columns beyond those of documents are kept, whatever their names. Texts may be of any length.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairwarden.llm.decontamination import mark_contamination
from pairwarden.llm.exact_dedup import keep_one as keep_one_copy
from pairwarden.llm.language_id import held_out, identify
from pairwarden.llm.packing import pack_powers
from pairwarden.llm.shipping import prepare
from pairwarden.llm.simhash_dedup import keep_one as keep_one_near_copy
from pairwarden.session import stage


def _free(docs: DataFrame, name: str) -> str:
    """A column name that ``docs`` does not have."""
    while name in docs.columns:
        name += "_"
    return name


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents whose language is rejected: no letters, or a narrow margin."""
    prepare(spark)
    own = _free(docs, "_language")
    found = identify(docs, docs.filter(~held_out("doc_id", 5, 0)), column=own)
    return found.filter(~F.col(f"{own}.rejected")).select(*docs.columns)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the row with the largest id of equal texts."""
    prepare(spark)
    return keep_one_copy(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the row with the smallest id of each SimHash component."""
    prepare(spark)
    return keep_one_near_copy(docs, shingle=3, max_distance=3)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a window of a benchmark item."""
    prepare(spark)
    own = _free(docs, "_contamination")
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    marked = mark_contamination(docs, benchmark, column=own)
    return marked.filter(~F.col(f"{own}.contaminated")).select(*docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents that are left; see ``pack_powers``."""
    prepare(spark)
    return pack_powers(docs, longest=2048, end_id=1)


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("packing", packing),
]

#: Compression classification, XXH64 fingerprints and tokenizers are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
