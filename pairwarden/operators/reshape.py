"""Long/wide reshaping, count matrices, value shares, stacking."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairwarden.functions.times import at, bucket


def to_wide(df: DataFrame, time: str, tag: str, value: str, tags: Sequence[str]) -> DataFrame:
    """Sum per (time, tag), one column per tag; an absent cell is NULL.

    A cell whose values are all NULL sums to 0.
    """
    cell = F.coalesce(F.col(value), F.lit(0.0))
    return (
        df.select(time, tag, cell.alias("_v"))
        .groupBy(time)
        .pivot(tag, list(tags))
        .agg(F.sum("_v"))
    )


def to_wide_text(df: DataFrame, time: str, tag: str, value: str, tags: Sequence[str]) -> DataFrame:
    """Text per (time, tag), one column per tag, after one row per key was kept."""
    return df.groupBy(time).pivot(tag, list(tags)).agg(F.min(value))


def count_matrix(
    df: DataFrame, time: str, rule: str, rules: Sequence[int], width: str = "10 minutes"
) -> DataFrame:
    """Hits per bucket and rule for a fixed rule list (columns ``r<id>``).

    Missing cells are 0 and other rules are not counted, but a bucket that holds
    only those stays as a row of zeros.
    """
    cells = [
        F.count(F.when(F.col(rule) == r, True)).alias(f"r{r}") for r in rules
    ]
    return df.groupBy(bucket(time, width).alias("bucket")).agg(*cells)


def complete_rows(df: DataFrame) -> DataFrame:
    return df.na.drop("any")


def tags_of_type(catalogue: DataFrame, kind: str) -> list[str]:
    """Tags of one type in name order (the catalogue is a settings file)."""
    return sorted(r.tag_name for r in catalogue.filter(F.col("type") == kind).collect())


def select_type(wide: DataFrame, catalogue: DataFrame, kind: str, ids: Sequence[str]) -> DataFrame:
    """Columns of the tags of one type, sorted by name, after the id columns."""
    present = [t for t in tags_of_type(catalogue, kind) if t in wide.columns]
    return wide.select(*ids, *present)


def to_long(wide: DataFrame, ids: Sequence[str], name: str = "tag_name", value: str = "tag_value") -> DataFrame:
    """One row per non-NULL cell, id columns repeated."""
    cells = [c for c in wide.columns if c not in ids]
    return wide.unpivot(list(ids), cells, name, value).filter(F.col(value).isNotNull())


def value_rates(
    df: DataFrame, cols: Sequence[str], by: Sequence[str] = (), top: int | None = None
) -> DataFrame:
    """Count and share of all values of each column.

    ``top`` keeps the most frequent values of each column only and adds their ``rank``;
    map tasks then drop what cannot be among them (window group limit).
    """
    texts = df.select(*by, *[F.col(c).cast("string").alias(c) for c in cols])
    counts = (
        texts.unpivot(list(by), list(cols), "column", "value")
        .filter("value is not null")
        .groupBy(*by, "column", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    totals = counts.groupBy(*by, "column").agg(F.sum("n").alias("n_all"))
    rates = ["value", "n", (F.col("n") / F.col("n_all")).alias("rate")]
    if top is not None:
        keys = ", ".join([*by, "`column`"])
        rank = F.expr(f"row_number() over (partition by {keys} order by n desc, value)")
        counts = counts.withColumn("rank", rank.cast("long")).filter(F.col("rank") <= top)
        rates = ["rank", *rates]
    return counts.join(totals, [*by, "column"]).select(*by, "column", *rates)


def value_rates_by(
    df: DataFrame, key: str, keys: DataFrame, cols: Sequence[str], top: int | None = None
) -> DataFrame:
    """``value_rates`` for each listed key value."""
    return value_rates(df.join(keys.select(key).distinct(), key, "left_semi"), cols, [key], top)


def score_counts(df: DataFrame, score: str, digits: int = 6) -> DataFrame:
    """How often each rounded score occurs."""
    return df.groupBy(F.round(score, digits).alias(score)).agg(F.count(F.lit(1)).alias("n"))


def single_events(df: DataFrame, kind: str, version) -> DataFrame:
    """Result rows of single events; ``milli_time`` repeats the time, cut to the second, as text."""
    milli = F.date_format("time", "yyyy-MM-dd HH:mm:ss")
    return df.select(
        "time", "ip", F.lit(kind).alias("type"), F.col("single_rule").cast("long").alias("single_rule"),
        "hash", at(version).alias("version"), "id", milli.alias("milli_time"),
    ).distinct()


def merge_sources(logs: DataFrame, packets: DataFrame) -> DataFrame:
    """Logs and packets under common names; columns of one kind are NULL in the other."""
    left = logs.withColumnRenamed("plant_id", "id").withColumn("single_rule_log", F.col("single_rule"))
    right = (
        packets.withColumnRenamed("make_id", "id")
        .withColumn("ip", F.col("src_ip"))
        .withColumn("single_rule_packet", F.col("single_rule"))
    )
    return left.distinct().unionByName(right.distinct(), allowMissingColumns=True)


def stack(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)
