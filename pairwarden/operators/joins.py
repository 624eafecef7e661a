"""Enrichment, exclusion and pair joins.

Settings and dimension tables go through ``lookup_join``: Spark broadcasts a side by its known
or measured bytes, else shuffles both. Joins on event hashes are left to adaptive execution, too.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairwarden.operators.lookup import lookup_join


def attach_address(logs: DataFrame, devices: DataFrame) -> DataFrame:
    """Address of each log's device; logs without one are dropped, several fan out."""
    named = devices.filter(F.col("ip_address") != "nan").select("device_id", "ip_address")
    return lookup_join(logs, named, ["device_id"]).withColumn("ip", F.col("ip_address"))


def exclude_seen(df: DataFrame, seen: DataFrame, key: str = "hash") -> DataFrame:
    """Rows whose key does not occur in ``seen``."""
    return df.join(seen.select(key).distinct(), key, "left_anti")


def label_pairs(pairs: DataFrame, rule_pairs: DataFrame) -> DataFrame:
    """Multi-rule ids (``corr``) of each rule pair; NULL without one, several fan out."""
    return lookup_join(pairs, rule_pairs, ["f_single_rule", "b_single_rule"], "left")


def _moved(positions: str, shift: int) -> Column:
    return F.transform(positions, lambda p: p + shift)


def _side_features(features: DataFrame, side: str, shift: int) -> DataFrame:
    return features.dropDuplicates(["hash"]).select(
        F.col("hash").alias(f"{side}_hash"), _moved("positions", shift).alias(f"_{side}")
    )


def attach_features(
    pairs: DataFrame, log_features: DataFrame, packet_features: DataFrame, log_size: int
) -> DataFrame:
    """Feature vector of a cross-kind pair: log part first, whichever event came first.

    Feature frames hold (hash, positions of the ones); packet positions follow the
    ``log_size`` log positions. An event without features contributes none.
    """
    empty = F.array().cast("array<long>")
    kinds = {"log": (log_features, 0), "packet": (packet_features, log_size)}
    both = None
    for kind, (frame, shift) in kinds.items():
        part = frame.dropDuplicates(["hash"]).select(
            F.lit(kind).alias("kind"), "hash", _moved("positions", shift).alias("part")
        )
        both = part if both is None else both.unionByName(part)
    out = pairs
    for side in ("f", "b"):
        renamed = both.select(
            F.col("kind").alias(f"{side}_type"),
            F.col("hash").alias(f"{side}_hash"),
            F.col("part").alias(f"_{side}"),
        )
        out = out.join(renamed, [f"{side}_type", f"{side}_hash"], "left")
    first, second = F.coalesce("_f", empty), F.coalesce("_b", empty)
    ordered = F.when(F.col("f_type") == "log", F.concat(first, second)).otherwise(
        F.concat(second, first)
    )
    return out.withColumn("features", ordered).drop("_f", "_b")


def attach_same_kind_features(pairs: DataFrame, features: DataFrame, size: int) -> DataFrame:
    """Feature vector of a same-kind pair: front part, then back part."""
    empty = F.array().cast("array<long>")
    out = pairs.join(_side_features(features, "f", 0), "f_hash", "left")
    out = out.join(_side_features(features, "b", size), "b_hash", "left")
    joined = F.concat(F.coalesce("_f", empty), F.coalesce("_b", empty))
    return out.withColumn("features", joined).drop("_f", "_b")


def natural_join(left: DataFrame, right: DataFrame, how: str = "inner") -> DataFrame:
    """Join on every shared column."""
    return left.join(right, [c for c in left.columns if c in right.columns], how)


def orient_packet_ip(pairs: DataFrame, packets: DataFrame) -> DataFrame:
    """Address of the packet end of a pair: its target in front, its origin at the back.

    Rows with any NULL are dropped; a pair of two packets yields a row for each end.
    """
    known = packets.select("hash", "src_ip", "dst_ip").distinct()
    front = pairs.join(known.withColumnRenamed("hash", "f_hash"), "f_hash")
    back = pairs.join(known.withColumnRenamed("hash", "b_hash"), "b_hash")
    return (
        front.withColumn("f_ip", F.col("dst_ip"))
        .unionByName(back.withColumn("b_ip", F.col("src_ip")))
        .na.drop("any")
    )


def same_asset(pairs: DataFrame, assets: DataFrame) -> DataFrame:
    """Multi-rule pairs whose two addresses belong to the same asset."""
    out = pairs.filter(F.col("corr") != 0)
    for side in ("f", "b"):
        renamed = assets.select(
            F.col("asset_ip").alias(f"{side}_ip"), F.col("asset").alias(f"{side}_asset")
        ).distinct()
        out = lookup_join(out, renamed, [f"{side}_ip"])
    return out.filter(F.col("f_asset") == F.col("b_asset"))


def attach_multi(pairs: DataFrame, mapping: DataFrame) -> DataFrame:
    """Multi-rule id of the front rule, 0 without one."""
    ids = mapping.select(
        F.col("multi_id").alias("corr"), F.col("rule_id").alias("f_single_rule")
    ).distinct()
    joined = lookup_join(pairs, ids, ["f_single_rule"], "left")
    return joined.withColumn("corr", F.coalesce("corr", F.lit(0).cast("long")))


def events_in(df: DataFrame, buckets: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Events whose bucket is listed."""
    return df.join(buckets.select(*keys).distinct(), list(keys), "left_semi")


def restore_meta(long: DataFrame, source: DataFrame, keys=("tag_name", "date_time")) -> DataFrame:
    """Give long rows back the columns of the reading they came from."""
    extra = [c for c in source.columns if c not in long.columns or c in keys]
    return long.join(source.select(*extra), list(keys))
