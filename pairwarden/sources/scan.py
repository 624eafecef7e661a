"""Scans: ranges, federated sources, dimensions, the tag catalogue."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairwarden.functions.times import at, parse_lenient
from pairwarden.schemas import CATALOGUE


def _moment(value) -> datetime:
    return value if isinstance(value, datetime) else datetime.fromisoformat(value)


def scan_range(df: DataFrame, col: str, start, end) -> DataFrame:
    """Rows between two times, both ends included; the filter reaches the scan."""
    lo, hi = (at(_moment(v)) for v in (start, end))
    return df.filter(F.col(col).between(lo, hi))


def scan_range_text(df: DataFrame, col: str, start, end) -> DataFrame:
    """``scan_range`` on 14+ digit time texts at second resolution.

    Such texts sort like times, so plain comparisons do and can be pushed down.
    """
    lo = _moment(start).strftime("%Y%m%d%H%M%S")
    after = (_moment(end).replace(microsecond=0) + timedelta(seconds=1)).strftime("%Y%m%d%H%M%S")
    return df.filter((F.col(col) >= lo) & (F.col(col) < after))


def scan_range_any(df: DataFrame, cols: Sequence[str], start, end) -> DataFrame:
    """Rows where any of several time texts lies in the range; bad text counts as epoch."""
    lo, hi = (at(_moment(v)) for v in (start, end))
    hits = [parse_lenient(c).between(lo, hi) for c in cols]
    return df.filter(reduce(lambda a, b: a | b, hits))


def federated_union(frames: Mapping[str, DataFrame], tag: str = "clickhouse_server") -> DataFrame:
    """The same query over several servers, stacked and tagged with the server name."""
    tagged = [df.withColumn(tag, F.lit(name)) for name, df in frames.items()]
    return reduce(lambda a, b: a.unionByName(b), tagged)


def scan_dim(df: DataFrame, cols: Sequence[str], nonempty: Sequence[str] = ()) -> DataFrame:
    """Distinct dimension rows; the ``nonempty`` key columns must be filled."""
    for c in nonempty:
        df = df.filter(F.col(c) != "")
    return df.select(*cols).distinct()


def read_catalogue(spark: SparkSession, path: str) -> DataFrame:
    """Tag catalogue from a CSV file with a header."""
    return spark.read.schema(CATALOGUE).csv(path, header=True)
