"""Operators along the time order: pairs, look-back windows, key-wise firsts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pairwarden.operators.ordering import number_rows, same_group, spread, with_group_bounds


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """First row per key in ``order``.

    An aggregate rather than a ranking window: map tasks reduce a hot key to one row
    before anything is shuffled.
    """
    rest = [c for c in df.columns if c not in keys]
    first = F.min_by(F.struct(*rest), F.struct(*[F.col(c) for c in order]))
    return df.groupBy(*keys).agg(first.alias("_row")).select(*keys, "_row.*").select(*df.columns)


def merge_excess(
    df: DataFrame, rule_ids: Sequence[int], keys: Sequence[str], rule: str = "single_rule"
) -> DataFrame:
    """For noisy rules keep the smallest hash per key; other rules are untouched."""
    noisy = F.coalesce(F.col(rule).isin(*rule_ids), F.lit(False))
    merged = keep_first(df.filter(noisy), [*keys, rule], ["hash"])
    return df.filter(~noisy).unionByName(merged)


def _pair(cols: Sequence[str], side: str, row: str) -> list:
    return [F.col(row).getField(c).alias(f"{side}_{c}") for c in cols]


def skip_pairs(
    df: DataFrame,
    order: Sequence[str],
    cols: Sequence[str],
    n: int = 1,
    by: Sequence[str] = (),
    junctions: bool = False,
) -> DataFrame:
    """Pairs of a row and the 1st to n-th row after it, within ``by`` groups.

    Columns come out as ``f_*`` and ``b_*`` with the distance in ``step``. With
    ``junctions`` the pairs that arise between appended copies are added: (j, j-x)
    and (last, first), as negative steps.
    """
    kept = list(dict.fromkeys([*by, *order, *cols]))
    indexed, total = number_rows(df.select(*kept), [*by, *[o for o in order if o not in by]])
    back = n - 1 if junctions else 0
    if junctions:
        indexed = with_group_bounds(indexed, by, total)
        kept = [*kept, "_first", "_size"]
    placed = spread(indexed, back, n)
    row = F.struct("idx", *kept)
    window = Window.partitionBy("_chunk").orderBy("idx")
    ahead = [F.struct(F.lit(k).alias("step"), F.lead(row, k).over(window).alias("b")) for k in range(1, n + 1)]
    behind = [F.struct(F.lit(-x).alias("step"), F.lag(row, x).over(window).alias("b")) for x in range(1, back + 1)]
    pairs = (
        placed.withColumn("f", row)
        .withColumn("_next", F.array(*ahead, *behind))
        .filter("_home")
        .select("f", F.explode("_next").alias("_next"))
        .select("f", "_next.step", "_next.b")
        .filter(F.col("b").isNotNull() & same_group(F.col("f"), F.col("b"), by))
    )
    if junctions:
        place, size = F.col("f.idx") - F.col("f._first"), F.col("f._size")
        inner = (place >= 1 - F.col("step")) & (place <= size - 2)
        pairs = pairs.filter((F.col("step") > 0) | inner)
    out = pairs.select(*_pair(cols, "f", "f"), *_pair(cols, "b", "b"), F.col("step").cast("long").alias("step"))
    if junctions and n > 1:
        out = out.unionByName(_wrap_pairs(indexed, cols, n, by))
    return out


def _wrap_pairs(indexed: DataFrame, cols: Sequence[str], n: int, by: Sequence[str]) -> DataFrame:
    """(last row, first row) of each group, once per appended block that is not empty."""
    fields = F.struct(*cols)
    ends = indexed.groupBy(*by).agg(
        F.max_by(fields, "idx").alias("f"),
        F.min_by(fields, "idx").alias("b"),
        F.max("_size").alias("_size"),
    )
    blocks = F.least(F.lit(n - 1).cast("long"), F.col("_size") - 2)
    return (
        ends.filter(F.col("_size") > 2)
        .withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), blocks)))
        .select(*_pair(cols, "f", "f"), *_pair(cols, "b", "b"), (1 - F.col("_size")).alias("step"))
    )


def adjacent_pairs(
    df: DataFrame, order: Sequence[str], cols: Sequence[str], by: Sequence[str] = ()
) -> DataFrame:
    """Each row with the next one in ``order``."""
    return skip_pairs(df, order, cols, 1, by).drop("step")


def split_pairs(pairs: DataFrame, cross_only: bool = True) -> tuple[DataFrame, DataFrame]:
    """Training pairs (a multi-rule was found) and hold-out pairs (none)."""
    held = pairs.filter("corr is null")
    if cross_only:
        held = held.filter(F.col("f_type") != F.col("b_type"))
    return pairs.filter("corr is not null"), held


def lookback(
    df: DataFrame,
    order: Sequence[str],
    cols: Sequence[str],
    steps: int,
    by: Sequence[str] = (),
    inclusive: bool = False,
) -> DataFrame:
    """Add ``window``: the values of the ``steps`` rows before each row, oldest first.

    Rows without enough predecessors get a window of zeros; a group with at most
    ``steps`` rows has no windows (NULL). ``inclusive`` ends the window with the row
    itself and leaves out the group's last row.
    """
    indexed, total = number_rows(df, [*by, *[o for o in order if o not in by]])
    indexed = with_group_bounds(indexed, by, total)
    placed = spread(indexed, steps, 0)
    frame = Window.partitionBy("_chunk", *by).orderBy("idx")
    frame = frame.rowsBetween(1 - steps, 0) if inclusive else frame.rowsBetween(-steps, -1)
    values = F.array(*[F.col(c).cast("double") for c in cols])
    zeros = F.array_repeat(F.array(*[F.lit(0.0) for _ in cols]), steps)
    seen = F.col("idx") - F.col("_first") + (1 if inclusive else 0)
    window = (
        F.when(F.col("_size") <= steps, None).when(seen < steps, zeros).otherwise(F.col("_window"))
    )
    out = placed.withColumn("_window", F.collect_list(values).over(frame)).filter("_home")
    if inclusive:
        out = out.filter(F.col("idx") < F.col("_first") + F.col("_size") - 1)
    return out.withColumn("window", window).select(*df.columns, "window")


def shift_ones(df: DataFrame, order: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Values of the row before; the first row gets ones."""
    indexed, _ = number_rows(df, order)
    window = Window.partitionBy("_chunk").orderBy("idx")
    moved = spread(indexed, 1, 0)
    for c in cols:
        moved = moved.withColumn(f"_{c}", F.lag(c).over(window))
    first = F.col("idx") == 0
    shifted = [
        F.when(first, 1.0).otherwise(F.col(f"_{c}")).alias(c) if c in cols else F.col(c)
        for c in df.columns
    ]
    return moved.filter("_home").select(*shifted)
