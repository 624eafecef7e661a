"""Routing by a table of prefixes: each value goes to the longest prefix it starts with.

All values that start with a prefix lie, by bytes, in one range that begins with it. Sorted, the
ends of these ranges, nested ones included, cut all texts into ranges of one longest prefix each,
and a binary search finds a value's. Tables of a hundred thousand prefixes are thus as
cheap a value as small ones; each different value of a batch is searched once.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairwarden.operators.lookup import lookup_join
from pairwarden.session import ship_package, stage

MAX_PREFIXES = 2_000_000  # every task holds the table's prefixes


def _after(prefix: bytes) -> bytes | None:
    """First text after all that start with ``prefix``; None if there is none."""
    kept = prefix.rstrip(b"\xff")
    return kept[:-1] + bytes([kept[-1] + 1]) if kept else None


def prefix_ranges(prefixes: Sequence[tuple[bytes, int]]) -> tuple[list[bytes], list[int]]:
    """(starts, number of the longest prefix from there on, -1 for none)."""
    starts, owners, open_ = [b""], [-1], []  # open_: (end, number) of the prefixes around a place

    def begin(place: bytes, owner: int) -> None:
        if starts[-1] == place:
            owners[-1] = owner
        else:
            starts.append(place)
            owners.append(owner)

    def close(until: bytes | None) -> None:
        while open_ and open_[-1][0] is not None and (until is None or open_[-1][0] <= until):
            end, _ = open_.pop()
            begin(end, open_[-1][1] if open_ else -1)

    for prefix, number in sorted(prefixes):
        close(prefix)
        begin(prefix, number)
        open_.append((_after(prefix), number))
    close(None)
    return starts, owners


def route_by_table(df: DataFrame, col: str, routes: DataFrame, prefix: str = "prefix") -> DataFrame:
    """Attach the columns of the route whose ``prefix`` is the longest that ``col`` starts with.

    Rows without one are dropped, nulls among them; the empty prefix takes everything. A prefix that
    is listed twice is an error. Route columns must not be named like columns of ``df``.
    """
    ship_package(df.sparkSession)
    listed = stage(routes.filter(F.col(prefix).isNotNull()).withColumn(
        "_route", F.monotonically_increasing_id()), "routes")
    found, different = listed.agg(F.count("*"), F.countDistinct(prefix)).first()
    if found != different:
        raise ValueError("a prefix is listed twice")
    if found > MAX_PREFIXES:
        raise ValueError(f"{found} prefixes exceed {MAX_PREFIXES}")
    rows = listed.select(prefix, "_route").collect()  # a checked number
    starts, owners = prefix_ranges([(r[0].encode(), r[1]) for r in rows])
    numbers = np.array(owners, np.int64)

    def route(values: pa.Array) -> pa.Array:
        coded = pc.dictionary_encode(values)
        places = [bisect_right(starts, v) - 1 for v in coded.dictionary.cast(pa.binary()).to_pylist()]
        owner = np.append(numbers[places], -1)[coded.indices.fill_null(len(places)).to_numpy(zero_copy_only=False)]
        return pa.array(owner, mask=owner < 0)

    routed = df.withColumn("_route", F.arrow_udf(route, "long")(F.col(col).cast("string"))).filter("_route is not null")
    return lookup_join(routed, listed.drop(prefix), ["_route"]).drop("_route")
