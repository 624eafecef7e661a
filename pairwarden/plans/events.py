"""From raw log and packet tables to enriched rule hits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairwarden.functions.columns import any_nonempty, event_kind, maker
from pairwarden.functions.times import parse_fraction, parse_second
from pairwarden.operators.joins import attach_address
from pairwarden.operators.rules import Rule, match_rules
from pairwarden.sources.scan import scan_range_text


def log_hits(logs: DataFrame, rules: list[Rule], start, end) -> DataFrame:
    """Rule hits of the logs in a time range."""
    return match_rules(scan_range_text(logs, "loged_time", start, end), rules, "loged_time")


def enrich_logs(hits: DataFrame, devices: DataFrame) -> DataFrame:
    """Logs with address, parsed time and common column names; copies are dropped.

    The hash covers all source columns, so copies are found by it and the other
    columns are free to be pruned.
    """
    return (
        attach_address(hits, devices)
        .dropDuplicates(["hash", "single_rule", "ip_address"])
        .withColumn("id", F.col("plant_id"))
        .withColumn("type", event_kind("message_id"))
        .withColumn("time_text", F.col("loged_time"))
        .withColumn("time", parse_second("loged_time"))
        .withColumn("milli_time", F.date_format("time", "yyyy-MM-dd HH:mm:ss"))
    )


def without_source(logs: DataFrame, source: str) -> DataFrame:
    """Rule hits that are not of the exclusion source; a row says so itself, no join is needed."""
    return logs.filter(~F.col("source").eqNullSafe(source))


def packet_events(packets: DataFrame, rules: list[Rule], start, end) -> DataFrame:
    """Rule hits of the packets in a time range, with common column names."""
    hits = match_rules(scan_range_text(packets, "packet_time", start, end), rules, "packet_time")
    return (
        any_nonempty(hits, ["src_ip", "dst_ip"])
        .dropDuplicates(["hash", "single_rule"])
        .withColumn("id", F.col("make_id"))
        .withColumn("ip", F.col("src_ip"))
        .withColumn("type", event_kind("message_id"))
        .withColumn("manufacturer_name", maker("make_id"))
        .withColumn("time_text", F.col("packet_time"))
        .withColumn("time", parse_second("packet_time"))
        .withColumn("milli_time", F.date_format(parse_fraction("packet_time"), "yyyy-MM-dd HH:mm:ss.SSS"))
    )


def unit_of() -> Column:
    """Unit number from the machine name of a log or the end of a packet's unit id."""
    from_name = F.regexp_extract(F.coalesce("machine_no", F.lit("")), "^([0-9]+)호기$", 1)
    return F.when(from_name != "", from_name).otherwise(F.expr("right(unit_id, 1)"))


PAIR_COLS = ("time", "ip", "type", "single_rule", "hash", "id", "milli_time")


def pair_rows(frames: Sequence[DataFrame], extra: Sequence[str] = ()) -> DataFrame:
    """The columns that pairs need, logs and packets stacked (NULL where a kind lacks one)."""
    keep = list(dict.fromkeys([*PAIR_COLS, "time_text", *extra]))
    out = None
    for df in frames:
        part = df.select(*[c for c in keep if c in df.columns])
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out
