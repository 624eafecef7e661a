"""Packing by power-of-two decomposition.

A document's ids (its text's, then the end id) are split into pieces whose lengths are
powers of two: full pieces of the longest length, then the binary digits of the rest.
Every piece is a sequence of its own, so no sequence crosses documents and none is padded;
sequences of equal length form a bucket and are numbered together, longest bucket first,
so that a trainer draws batches of one length from consecutive numbers.

Null and empty texts are a single end id. Rows are independent; repeated rows and null
ids are packed like any other.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pairwarden.llm.tables import narrow
from pairwarden.llm.tokens import WORD_BPE, word_tokenizer
from pairwarden.session import stage

_STEP = 512  # texts encoded at once


def piece_lengths(n: int, longest: int) -> list[int]:
    """Powers of two, descending, that add up to ``n``."""
    full, rest = divmod(n, longest)
    return [longest] * full + [1 << b for b in range(longest.bit_length() - 1, -1, -1) if rest >> b & 1]


def _pieces(path: str, longest: int, end_id: int, with_ids: bool):
    end = np.array([end_id], "<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = word_tokenizer(path)
        part_id, seen = TaskContext.get().partitionId(), Counter()
        for batch in batches:
            for at in range(0, batch.num_rows, _STEP):
                part = batch.slice(at, _STEP)
                docs, starts, lengths, sums, totals, numbers, pieces = [], [], [], [], [], [], []
                found, bounds = tokenizer.encode_column(part.column(1))
                for n, doc in enumerate(part.column(0).to_pylist()):
                    ids = found[bounds[n] : bounds[n + 1]].tobytes() + end
                    start = 0
                    own = piece_lengths(len(ids) // 4, longest)
                    for length in own:
                        piece = ids[4 * start : 4 * (start + length)]
                        starts.append(start)
                        sums.append(zlib.crc32(piece))
                        numbers.append(seen[length])
                        seen[length] += 1
                        if with_ids:
                            pieces.append(np.frombuffer(piece, "<u4").astype(np.int32))
                        start += length
                    docs += [doc] * len(own)
                    lengths += own
                    totals += [len(ids) // 4] * len(own)
                columns = [pa.array(c, pa.int64()) for c in (docs, starts, lengths, sums, totals, numbers)]
                columns.append(pa.array([part_id] * len(docs), pa.int64()))
                names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "_n", "_part"]
                if with_ids:
                    columns.append(pa.array(pieces, pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return cut


def pack_powers(docs: DataFrame, path: str = WORD_BPE, longest: int = 2048, end_id: int = 1,
                with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, bucket
    (the sequence's length) and, with ``with_ids``, the ids themselves.

    ``longest`` is a power of two. Sequence numbers are dense and ordered by bucket.
    """
    if longest & (longest - 1):
        raise ValueError("longest must be a power of two")
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, _n long, _part long"
    pieces = stage(
        narrow(docs).mapInArrow(
            _pieces(path, longest, end_id, with_ids), schema + (", ids array<int>" if with_ids else "")
        ),
        "pieces",
    )
    starts = _bucket_starts(pieces.groupBy("length", "_part").count())
    return (
        pieces.join(starts, ["length", "_part"])
        .withColumn("sequence_id", F.col("_start") + F.col("_n"))
        .withColumn("offset", F.lit(0).cast("long"))
        .withColumn("bucket", F.col("length"))
        .drop("_part", "_n", "_start")
    )


def _bucket_starts(counts: DataFrame) -> DataFrame:
    """First sequence number of each (length, part): a dozen rows a part, summed by hundreds of parts."""
    counts = counts.withColumn("_hundred", F.expr("_part div 128"))
    blocks = counts.groupBy("length", "_hundred").agg(F.sum("count").alias("n"))
    before = Window.orderBy(F.col("length").desc(), "_hundred").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("_base", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    inside = Window.partitionBy("length", "_hundred").orderBy("_part").rowsBetween(
        Window.unboundedPreceding, -1
    )
    return (
        counts.withColumn("_in", F.coalesce(F.sum("count").over(inside), F.lit(0)))
        .join(blocks, ["length", "_hundred"])
        .select("length", "_part", (F.col("_base") + F.col("_in")).alias("_start"))
    )
