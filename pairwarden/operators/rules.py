"""Single-event rules and the multi-rule mapping.

Rules are a small settings table: ``rule_id, kind (1 packet, 2 log), source,
state, predicate``. A predicate is a Spark SQL condition over the event columns.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairwarden.schemas import RULE

PACKET, LOG = 1, 2


@dataclass(frozen=True)
class Rule:
    rule_id: int
    kind: int
    source: str | None
    state: str | None
    predicate: str | None

    def condition(self) -> str:
        """Predicate in parentheses, limited to the rule's source table."""
        test = f"({self.predicate})" if self.predicate else "(true)"
        if not self.source:
            return test
        source = self.source.replace("\\", "\\\\").replace("'", "\\'")  # as Spark spells a text
        return f"source = '{source}' and {test}"


def rules_frame(spark: SparkSession, rules: list[Rule]) -> DataFrame:
    rows = [(r.rule_id, r.kind, r.source, r.state, r.predicate) for r in rules]
    return spark.createDataFrame(rows, RULE)


def load_rules(rules: DataFrame) -> list[Rule]:
    """Rules of a settings table on the driver, where the match condition is built."""
    rows = rules.select("rule_id", "kind", "source", "state", "predicate").collect()
    return [Rule(*row) for row in sorted(rows, key=lambda r: r.rule_id)]


def match_rules(df: DataFrame, rules: list[Rule], time: str = "time") -> DataFrame:
    """One row per (event, rule) that holds, in a single scan for all rules.

    Works on batches and streams alike. ``df`` already carries ``hash``; ``time``
    names its time column. The scan gets the rules' conditions, joined by OR, as a filter.
    """
    if rules and all(r.source or r.predicate for r in rules):
        df = df.filter(" or ".join(f"({r.condition()})" for r in rules))
    hits = [F.when(F.expr(r.condition()), F.lit(r.rule_id).cast("long")) for r in rules]
    if not hits:
        hits = [F.lit(None).cast("long")]
    found = F.filter(F.array(*hits), lambda x: x.isNotNull())
    out = df.withColumn("single_rule", F.explode(found))
    return out if time == "time" else out.withColumn("time", F.col(time))


def select_rules(rules: DataFrame, kind: int, active_only: bool = False) -> DataFrame:
    """Rules of one kind; optionally without the states D and DE (and NULL, as in SQL)."""
    chosen = rules.filter(F.col("kind") == kind)
    if active_only:
        chosen = chosen.filter((F.col("state") != "D") & (F.col("state") != "DE"))
    return chosen


def route_rules(rules: DataFrame, sources=("L005", "L009", "L011")) -> DataFrame:
    """Log rules that read one of the known source tables."""
    return rules.filter(F.col("source").isin(*sources))


def _side(mapping: DataFrame, kind: int, name: str, active_only: bool) -> DataFrame:
    return select_rules(mapping, kind, active_only).select(
        F.col("multi_id").alias("corr"), F.col("rule_id").alias(name)
    ).distinct()


def rule_mapping(mapping: DataFrame, active_only: bool = False) -> DataFrame:
    """Log and packet rules of each multi-rule side by side; a missing side is 0."""
    log = _side(mapping, LOG, "single_rule_log", active_only)
    packet = _side(mapping, PACKET, "single_rule_packet", active_only)
    return log.join(packet, "corr", "full").na.fill(0).distinct()


def symmetric_pairs(mapped: DataFrame) -> DataFrame:
    """Rule pairs in both orders, log first and packet first; not de-duplicated."""
    log, packet = F.col("single_rule_log"), F.col("single_rule_packet")
    front = mapped.select("corr", log.alias("f_single_rule"), packet.alias("b_single_rule"))
    back = mapped.select("corr", packet.alias("f_single_rule"), log.alias("b_single_rule"))
    return front.unionByName(back)


def same_kind_pairs(mapping: DataFrame, kind: int = LOG, active_only: bool = True) -> DataFrame:
    """All ordered pairs of rules that share a multi-rule, pairs of one rule included.

    Both sides are distinct, so each pair of a multi-rule is met once.
    """
    front = _side(mapping, kind, "f_single_rule", active_only)
    back = _side(mapping, kind, "b_single_rule", active_only)
    return front.join(back, "corr")


def rules_in_use(rules: DataFrame, mapping: DataFrame) -> DataFrame:
    """Rules that occur in any multi-rule."""
    return rules.join(mapping, "rule_id", "left_semi")
