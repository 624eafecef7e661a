"""Token counts from an exact length histogram.

Documents are aggregated by encoded length; the histogram is all that later questions
need. Its suffix sums answer, for every context limit L: documents and tokens of length
L or more, tokens left when every document is cut at L, tokens of documents that fit,
and the quantile that L is. Suffix sums run per block of lengths, plus one row per block,
so no task holds the histogram.

Null and empty texts have length 0. Every row counts, repeated ones too. Texts may be of any
length and kind, runs of millions of white-space characters included.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pairwarden.llm.tables import narrow
from pairwarden.llm.tokens import BYTE_BPE, byte_tokenizer

_BLOCK = 128  # lengths per window


def encoded_lengths(docs: DataFrame, path: str = BYTE_BPE) -> DataFrame:
    """(doc_id, n_tokens) of every row."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = byte_tokenizer(path).encode
        for batch in batches:
            lengths = [len(encode(t)) if t else 0 for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(lengths, pa.int64())], names=["doc_id", "n_tokens"]
            )

    return narrow(docs).mapInArrow(count, "doc_id long, n_tokens long")


def length_histogram(lengths: DataFrame) -> DataFrame:
    return lengths.groupBy("n_tokens").agg(F.count("*").alias("n_docs"))


def context_totals(histogram: DataFrame) -> DataFrame:
    """One row per length L = n_tokens that occurs: n_docs; docs_from and tokens_from (length L or
    more); total_tokens_cut (every document cut at L); tokens_fitting (documents of at most L);
    quantile (share of documents of at most L). Limits between two lengths: ``cut_at``."""
    sized = histogram.withColumn("tokens", F.col("n_tokens") * F.col("n_docs")).withColumn(
        "block", F.expr(f"n_tokens div {_BLOCK}")
    )
    blocks = sized.groupBy("block").agg(F.sum("n_docs").alias("d"), F.sum("tokens").alias("t"))
    later = Window.orderBy(F.col("block").desc()).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    blocks = blocks.select(  # one row per block of lengths
        "block",
        *[F.coalesce(F.sum(c).over(later), F.lit(0)).alias(f"{c}_later") for c in "dt"],
        *[F.sum(c).over(everything).alias(f"{c}_all") for c in "dt"],
    )
    inside = Window.partitionBy("block").orderBy(F.col("n_tokens").desc())
    suffix = [
        (F.sum(c).over(inside) + F.col(f"{k}_later")).alias(a)
        for c, k, a in (("n_docs", "d", "docs_from"), ("tokens", "t", "tokens_from"))
    ]
    full = sized.join(blocks, "block").select("n_tokens", "n_docs", "tokens", "d_all", "t_all", *suffix)
    return full.select(
        "n_tokens", "n_docs", "docs_from", "tokens_from",
        (F.col("t_all") - F.col("tokens_from") + F.col("n_tokens") * F.col("docs_from")).alias("total_tokens_cut"),
        (F.col("t_all") - F.col("tokens_from") + F.col("tokens")).alias("tokens_fitting"),
        ((F.col("d_all") - F.col("docs_from") + F.col("n_docs")) / F.col("d_all")).alias("quantile"),
    )


def cut_at(totals: DataFrame, limit: int) -> Column | int:
    """Tokens left when every document is cut at any ``limit``, from the suffix sums."""
    above = totals.filter(F.col("n_tokens") >= limit).orderBy("n_tokens").head()
    if above is None:  # every document is shorter
        last = totals.agg(F.max("tokens_fitting")).head()[0]
        return last or 0
    shorter = above.total_tokens_cut - above.n_tokens * above.docs_from
    return shorter + limit * above.docs_from


def length_quantile(totals: DataFrame, share: float) -> int | None:
    """Smallest length that at least ``share`` of the documents do not exceed."""
    row = totals.filter(F.col("quantile") >= share).agg(F.min("n_tokens")).head()
    return row[0]
