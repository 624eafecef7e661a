"""Joins against lookup sides, left to adaptive execution."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def lookup_join(
    left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner", null_safe: bool = False
) -> DataFrame:
    """Equi-join without a probe or a hint.

    Spark broadcasts a side by its known or measured bytes; otherwise both sides are
    shuffled and adaptive execution splits hot partitions.
    """
    if not null_safe:
        return left.join(right, list(on), how)
    renamed = right.select(
        *[F.col(c).alias(f"_r_{c}") for c in on],
        *[c for c in right.columns if c not in on],
    )
    test = reduce(
        lambda a, b: a & b, [left[c].eqNullSafe(renamed[f"_r_{c}"]) for c in on]
    )
    return left.join(renamed, test, how).drop(*[f"_r_{c}" for c in on])
