"""Exact de-duplication with a heavy-hitter split.

1. Each text is lower-cased (A-Z) and digested (SHA-256) once; ids and digests are staged.
2. Misra-Gries: every task keeps at most ``counters`` digests; their counts, added up,
   name every digest of more than 2/counters of all rows. At most ``counters`` candidates
   can have that many, so the list has a proven bound.
3. The candidates' winners and sizes are counted exactly over all rows and broadcast:
   rows of heavy digests are decided where they lie.
4. All other digests, each a small part of the rows, are aggregated and joined by shuffle.

Null texts count as empty. The row with the largest id stays; a null id is smaller than
any. Of repeated rows that share the largest id, one stays.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pairwarden.llm.tables import narrow, record, whole_rows
from pairwarden.session import stage

COUNTERS = 4096


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = pc.ascii_lower(batch.column(1).fill_null("")).cast(pa.binary())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([hashlib.sha256(t.as_buffer()).digest() for t in texts], pa.binary())],
            names=["doc_id", "digest"],
        )


def text_digests(docs: DataFrame) -> DataFrame:
    """(doc_id, digest of the lower-cased text) of every row."""
    return narrow(docs).mapInArrow(_digests, "doc_id long, digest binary")


def _misra_gries(counters: int):
    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, int] = {}
        for batch in batches:
            for item in batch.column(0).value_counts().to_pylist():  # add a batch, then cut back
                held[item["values"]] = held.get(item["values"], 0) + item["counts"]
            if len(held) > counters:
                cut = sorted(held.values(), reverse=True)[counters]
                held = {k: n - cut for k, n in held.items() if n > cut}
        if held:
            yield record(["digest", "n"], [list(held), list(held.values())], [pa.binary(), pa.int64()])

    return summarise


def heavy_digests(digests: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """Digests that may make up more than 2/counters of all rows; at most ``counters`` rows."""
    rows = digests.count()
    summed = digests.select("digest").mapInArrow(_misra_gries(counters), "digest binary, n long")
    return summed.groupBy("digest").agg(F.sum("n").alias("n")).filter(
        F.col("n") >= max(2, rows / counters)
    ).select("digest")


def _decided(rows: DataFrame, winners: DataFrame) -> DataFrame:
    return rows.join(winners, "digest").select(
        "doc_id", F.col("best.doc_id").alias("keep_id"), "group_size",
        F.struct("doc_id", "row").eqNullSafe(F.col("best")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def exact_duplicates(docs: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """doc_id, keep_id, group_size, kept and text_sha256 of every row, dropped ones too."""
    digests = stage(
        text_digests(docs).withColumn("row", F.monotonically_increasing_id()), "digests"
    )
    heavy = stage(heavy_digests(digests, counters), "heavy").hint("broadcast")  # <= counters rows
    best = [F.max(F.struct("doc_id", "row")).alias("best"), F.count("*").alias("group_size")]
    frequent = digests.join(heavy, "digest", "left_semi")
    winners = stage(frequent.groupBy("digest").agg(*best), "winners")
    rest = digests.join(heavy, "digest", "left_anti")
    return _decided(frequent, winners.hint("broadcast")).unionByName(
        _decided(rest, rest.groupBy("digest").agg(*best))
    )


def keep_one(docs: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """The rows of ``docs`` (all its columns) that stay.

    Rows are found again by id and digest. Of repeated rows that share both, one stays,
    whatever its other columns say.
    """
    decided = exact_duplicates(docs, counters).filter("kept").select(
        F.col("doc_id").alias("_keep_id"), F.unhex("text_sha256").alias("_keep_digest")
    )
    kept = stage(decided, "kept")
    rows = whole_rows(docs, _id=F.col("doc_id").cast("long"), _digest=_digest_of(F.col("text").cast("string")))
    found = rows.join(
        kept, F.col("_id").eqNullSafe(F.col("_keep_id")) & (F.col("_digest") == F.col("_keep_digest"))
    )
    repeated = text_digests(docs).groupBy("doc_id", "digest").count().filter("count > 1")
    if not repeated.isEmpty():
        found = found.dropDuplicates(["_keep_id", "_keep_digest"])
    return found.select("_doc.*")


@F.arrow_udf(T.BinaryType())
def _digest_of(texts: pa.Array) -> pa.Array:
    lowered = pc.ascii_lower(texts.fill_null("")).cast(pa.binary())
    return pa.array([hashlib.sha256(t.as_buffer()).digest() for t in lowered], pa.binary())
