"""Total order over a whole table without a one-task window.

``number_rows`` gives every row its position in a total order with one range
shuffle; ``spread`` cuts the ordered table into equal chunks that also hold the
few neighbours their rows look at. Look-ahead and look-back operators then run
as ordinary windows per chunk, so no task ever holds more than a chunk, whatever
the distribution of the keys.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairwarden.operators.lookup import lookup_join
from pairwarden.session import stage, staged_scope

CHUNK_ROWS = 8192
_LOCAL_BITS = 33  # monotonically_increasing_id: partition number above, row number below


def number_rows(df: DataFrame, order: Sequence[str], name: str = "idx") -> tuple[DataFrame, int]:
    """Add the 0-based position of each row in ``order``; also return the row count.

    Rows equal in ``order`` are told apart by a fingerprint of the whole row, and exact copies,
    which are interchangeable, by the place they were staged at. So the order is total, and
    range partitioning splits a hot time, a hot key and a hot row alike. The input is staged
    first: range partitioning reads it twice, once for the bounds of its ranges.
    """
    keys = [F.col(c) for c in order]
    tied = df.withColumn("_tie", F.xxhash64(*df.columns)).withColumn("_row", F.monotonically_increasing_id())
    with staged_scope(df.sparkSession):  # the unordered rows are needed no longer than until they are ordered
        first = stage(tied, "unordered")
        placed = (
            first.repartitionByRange(*keys, "_tie", "_row")
            .sortWithinPartitions(*keys, "_tie", "_row")
            .withColumn("_place", F.monotonically_increasing_id())
            .drop("_tie", "_row")
        )
        staged = stage(placed, "ordered", outlive=True)
    part = F.shiftright("_place", _LOCAL_BITS)
    local = F.col("_place").bitwiseAND((1 << _LOCAL_BITS) - 1)
    # one row per partition of the range shuffle
    sizes = sorted(staged.groupBy(part.alias("p")).agg((F.max(local) + 1).alias("n")).collect())
    starts, total = [], 0
    for size in sizes:
        starts.append((size.p, total))
        total += size.n
    offsets = df.sparkSession.createDataFrame(starts, "_part long, _start long")
    numbered = (
        staged.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .withColumn(name, local + F.col("_start"))
        .drop("_part", "_start", "_place")
    )
    return numbered, total


def spread(indexed: DataFrame, before: int, after: int, chunk: int = CHUNK_ROWS) -> DataFrame:
    """Assign rows to chunks of consecutive positions (``_chunk``).

    A row is repeated in a neighbouring chunk when a row there looks at it from at
    most ``after`` positions before it or ``before`` positions behind it; ``_home``
    marks the one copy that belongs to the chunk itself.
    """
    size = max(chunk, 8 * (before + after))
    first = F.expr(f"greatest(idx - {after}, 0L) div {size}")
    last = F.expr(f"(idx + {before}) div {size}")
    return indexed.withColumn("_chunk", F.explode(F.sequence(first, last))).withColumn(
        "_home", F.col("_chunk") == F.expr(f"idx div {size}")
    )


def group_bounds(indexed: DataFrame, by: Sequence[str]) -> DataFrame:
    """First position and size of each group of an index that starts with ``by``."""
    return indexed.groupBy(*by).agg(
        F.min("idx").alias("_first"), F.count(F.lit(1)).alias("_size")
    )


def with_group_bounds(indexed: DataFrame, by: Sequence[str], total: int) -> DataFrame:
    """Attach ``_first`` and ``_size`` of each row's group (the whole table without ``by``)."""
    if not by:
        return indexed.withColumn("_first", F.lit(0).cast("long")).withColumn(
            "_size", F.lit(total).cast("long")
        )
    bounds = stage(group_bounds(indexed, by), "groups")  # its size is then known to the join
    return lookup_join(indexed, bounds, list(by), null_safe=True)


def same_group(left: Column, right: Column, by: Sequence[str]) -> Column:
    """NULL-safe equality of the ``by`` fields of two row structs."""
    test = F.lit(True)
    for c in by:
        test = test & left.getField(c).eqNullSafe(right.getField(c))
    return test
