"""Log-packet correlation: training and prediction.

Event features travel through the pair window as columns of the events, so the
pairs are never shuffled again to look features or addresses up by hash.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairwarden.functions.columns import conform, cross_kind, exclude_patterns, fill_missing
from pairwarden.functions.times import at
from pairwarden.operators.autoencoder import Training, fit_network
from pairwarden.operators.features import balance, onehot_apply, onehot_fit
from pairwarden.operators.joins import label_pairs, same_asset
from pairwarden.operators.reconstruct import fit_sparse, prefix_losses, score_features
from pairwarden.operators.reshape import single_events
from pairwarden.operators.rules import LOG, PACKET, load_rules, rule_mapping, select_rules, symmetric_pairs
from pairwarden.operators.scoring import label, mad_threshold, minmax_fit
from pairwarden.operators.sequence import merge_excess, skip_pairs, split_pairs
from pairwarden.plans.events import (
    PAIR_COLS,
    enrich_logs,
    log_hits,
    packet_events,
    pair_rows,
    unit_of,
    without_source,
)
from pairwarden.plans.models import PairModel
from pairwarden.schemas import PAIR_RESULT, SINGLE_EVENT
from pairwarden.session import stage
from pairwarden.sources.sinks import fit_history, new_rows, stamp_batches, with_batch_no

# Rules whose repeated hits are merged.
EXCESS_RULES = (
    8, 9, 11, 12, 14, 15, 17, 18, 20, 21, 23, 24, 26, 27, 29, 30, 32, 33, 34, 36, 37, 41, 42, 44,
    45, 47, 48, 50, 51, 53, 54, 56, 57, 59, 60, 62, 63, 65, 66, 67, 79, 163, 164, 165, 166, 167,
    168, 169, 170, 171, 172, 173, 174, 175, 176, 177, 178, 179, 180, 181, 182, 183,
)
# Address patterns of security servers, whose logs are left out.
SECURITY_SERVERS = ("192.168.50.", "172.19.1.152", "172.19.2.152")
EXCESS_KEYS = ("id", "machine_no", "manufacturer_name", "loged_time", "ip")


@dataclass(frozen=True)
class CorrelationSettings:
    log_cols: Sequence[str]
    packet_cols: Sequence[str]
    skip_n: int = 1
    excess_rules: Sequence[int] = ()
    security_servers: Sequence[str] = ()
    exclusion_source: str | None = None
    units: Sequence[str] | None = None
    makers: Sequence[str] | None = None


def plant_settings(log_cols: Sequence[str], packet_cols: Sequence[str], skip_n: int = 1) -> CorrelationSettings:
    """The settings of the plants the fixed values above belong to."""
    return CorrelationSettings(
        log_cols, packet_cols, skip_n, EXCESS_RULES, SECURITY_SERVERS, "L009", ("1", "2"), ("ABB", "GE")
    )


@dataclass(frozen=True)
class Tables:
    """Inputs: raw events plus the settings and dimension tables."""

    logs: DataFrame
    packets: DataFrame
    devices: DataFrame
    rules: DataFrame
    mapping: DataFrame
    assets: DataFrame | None = None


def _events(tables: Tables, start, end) -> tuple[DataFrame, DataFrame]:
    """(all enriched logs, enriched packets)."""
    hits = log_hits(tables.logs, load_rules(select_rules(tables.rules, LOG)), start, end)
    packet_rules = load_rules(select_rules(tables.rules, PACKET))
    return enrich_logs(hits, tables.devices), packet_events(tables.packets, packet_rules, start, end)


def _features() -> Column:
    """Log part, then packet part of a cross-kind pair."""
    empty = F.array().cast("array<long>")
    front, back = F.coalesce("f_positions", empty), F.coalesce("b_positions", empty)
    return F.when(F.col("f_type") == "log", F.concat(front, back)).otherwise(F.concat(back, front))


def _encode(encoders, logs: DataFrame, packets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Events with the positions of their ones; packet positions follow the log ones."""
    shift = encoders["log"].size
    return (
        onehot_apply(encoders["log"], logs),
        onehot_apply(encoders["packet"], packets).withColumn(
            "positions", F.transform("positions", lambda p: p + shift)
        ),
    )


_TRAIN_COLS = ("type", "single_rule", "hash", "time_text")


@dataclass(frozen=True)
class Fitted:
    model: PairModel
    history: DataFrame
    train_scores: DataFrame
    holdout_scores: DataFrame


def fit_pair_model(
    train: DataFrame, held: DataFrame, encoders, size: int, k: int, model_id: int, run_time: datetime,
    balanced: bool = True, keep_original: bool = False, seed: int | None = None,
    hidden: Sequence[tuple[int, str]] | None = None, how: Training = Training(),
) -> Fitted:
    """Fit, threshold and hold-out scores over pairs with ``features``.

    With ``hidden`` layers the model is a network, and the history has its loss of each epoch;
    else it is linear with ``k`` directions, and the history has the loss with 0, 1, ... of them.
    ``seed`` balances by draws with replacement.

    After balancing, only the distinct feature combinations with their counts are
    needed: the fit, the scores and the weighted medians run on those. Copies made to balance
    rule patterns are weights here. Copying all rows a fixed number of times would change no
    mean, direction or median and is left out.
    """
    if balanced:
        key = ["f_single_rule", "b_single_rule"]
        weighted = balance(train, key, ["f_hash", "b_hash", "corr"], keep_original, seed)
    else:
        weighted = train.withColumn("copies", F.lit(1).cast("long"))
    combos = weighted.filter("copies > 0").groupBy("features").agg(F.sum("copies").alias("copies"))
    combos = stage(combos, "train-combos")
    if hidden is None:
        fitted = fit_sparse(combos, size, weight="copies", k=k)
        losses = prefix_losses(fitted, combos)
    else:
        fitted, losses, _ = fit_network(combos, "features", size, "copies", hidden, "hard_sigmoid", how)
    scored = stage(score_features(fitted, combos), "train-scores")
    total = scored.agg(F.sum("copies")).first()[0]
    threshold = mad_threshold(scored, "ai_rmse", weight="copies")
    model = PairModel(encoders, fitted, threshold, minmax_fit(scored, ["ai_rmse"])["ai_rmse"])
    history = fit_history(
        train.sparkSession, model_id, "corr", run_time, run_time, losses, (total, size)
    )
    rest = stage(held.groupBy("features").agg(F.count(F.lit(1)).alias("copies")), "holdout-combos")
    return Fitted(model, history, _distribution(scored), _distribution(score_features(fitted, rest)))


def _distribution(scored: DataFrame) -> DataFrame:
    return scored.groupBy("ai_rmse").agg(F.sum("copies").alias("n"))


def train_correlation(
    tables: Tables, settings: CorrelationSettings, start, end, run_time: datetime,
    k: int = 0, balanced: bool = True, model_id: int = 1, seed: int | None = None,
    hidden: Sequence[tuple[int, str]] | None = None, how: Training = Training(),
) -> Fitted:
    """Fit the pair model on multi-rule pairs of the time range; see ``fit_pair_model``."""
    logs, packets = _events(tables, start, end)
    if settings.exclusion_source:
        logs = without_source(logs, settings.exclusion_source)
    logs = stage(logs.select(*_TRAIN_COLS, *settings.log_cols), "train-logs")
    packets = stage(packets.select(*_TRAIN_COLS, *settings.packet_cols), "train-packets")
    encoders = {
        "log": onehot_fit(logs, settings.log_cols),
        "packet": onehot_fit(packets, settings.packet_cols),
    }
    size = encoders["log"].size + encoders["packet"].size
    cols = ["type", "single_rule", "hash", "positions"]
    rows = pair_rows(_encode(encoders, logs, packets), ["positions"])
    pairs = skip_pairs(rows, ["time_text", "hash", "single_rule"], cols, settings.skip_n)
    known = symmetric_pairs(rule_mapping(tables.mapping)).distinct()
    labelled = label_pairs(pairs, known).withColumn("features", _features())
    train, held = split_pairs(stage(labelled.drop("f_positions", "b_positions"), "train-pairs"))
    return fit_pair_model(
        train, held, encoders, size, k, model_id, run_time, balanced, seed=seed, hidden=hidden, how=how
    )


@dataclass(frozen=True)
class Predicted:
    """Single events (stamped by batch), prepared events and pairs of a run."""

    single_logs: DataFrame
    single_packets: DataFrame
    prepared: DataFrame
    pairs: DataFrame


@dataclass(frozen=True)
class Stored:
    """What earlier runs have stored; rows found there are left out."""

    singles: DataFrame | None = None
    prepared: DataFrame | None = None
    pairs: DataFrame | None = None


def _unseen(df: DataFrame, stored: DataFrame | None, keys: Sequence[str]) -> DataFrame:
    return df if stored is None else new_rows(df, stored, keys)


def _stamped(df: DataFrame, run_time: datetime) -> DataFrame:
    """The write time of each batch as version."""
    numbered = with_batch_no(df.drop("version"), ["time", "hash", "single_rule", "ip"])
    return conform(stamp_batches(numbered, at(run_time)), SINGLE_EVENT)


def _blank(df: DataFrame) -> DataFrame:
    """A space for missing texts."""
    return fill_missing(df, {}, [c for c, kind in df.dtypes if kind == "string"])


_RUN_COLS = (*PAIR_COLS, "time_text", "unit_id", "manufacturer_name")
_KIND_COLS = {"log": ("machine_no", "loged_time", "source"), "packet": ("src_ip", "dst_ip")}


def _run_events(tables: Tables, settings: CorrelationSettings, start, end) -> list[DataFrame]:
    """Enriched logs and packets with the columns that a run reads; staged, as singles, merging
    and pairs each read them."""
    chosen = {"log": settings.log_cols, "packet": settings.packet_cols}
    return [
        stage(df.select(*dict.fromkeys([*_RUN_COLS, *_KIND_COLS[kind], *chosen[kind]])), f"{kind}-events")
        for kind, df in zip(("log", "packet"), _events(tables, start, end), strict=True)
    ]


def predict_correlation(
    tables: Tables, settings: CorrelationSettings, model: PairModel, start, end, run_time: datetime,
    stored: Stored = Stored(),
) -> Predicted:
    """Single events, prepared events and scored same-asset pairs of a time range, without what is stored."""
    all_logs, packets = _run_events(tables, settings, start, end)
    logs = without_source(all_logs, settings.exclusion_source) if settings.exclusion_source else all_logs
    if settings.security_servers:
        logs = exclude_patterns(logs, "ip", settings.security_servers)
    logs = merge_excess(logs, settings.excess_rules, EXCESS_KEYS)
    extra = ["unit", "manufacturer_name", "src_ip", "dst_ip", "positions"]
    log_rows, packet_rows = _encode(model.encoders, logs, packets)
    rows = pair_rows(
        [
            # the two kinds share a column of thousandths here
            log_rows.withColumn("unit", unit_of()).withColumn(
                "milli_time", F.concat("milli_time", F.lit(".000"))
            ),
            packet_rows.withColumn("unit", F.expr("right(unit_id, 1)")),
        ],
        extra,
    )
    for col, wanted in (("unit", settings.units), ("manufacturer_name", settings.makers)):
        if wanted is not None:
            rows = rows.filter(F.col(col).isin(*wanted))
    pairs = skip_pairs(
        rows,
        ["time", "hash", "single_rule"],
        [*PAIR_COLS, "src_ip", "dst_ip", "positions"],
        settings.skip_n,
        by=["unit", "manufacturer_name"],
    ).drop("step")
    known = symmetric_pairs(rule_mapping(tables.mapping)).distinct()
    labelled = label_pairs(cross_kind(pairs), known).withColumn(
        "corr", F.coalesce("corr", F.lit(0).cast("long"))
    )
    single_logs, single_packets = (
        _stamped(_unseen(single_events(df, kind, run_time), stored.singles, ["hash"]), run_time)
        for kind, df in (("log", all_logs), ("packet", packets))
    )
    prepared = _blank(_unseen(rows.drop("positions"), stored.prepared, ["hash"]))
    return Predicted(
        single_logs, single_packets, prepared.withColumn("version", at(run_time)),
        score_pairs(labelled, tables.assets, model, run_time, stored.pairs),
    )


def score_pairs(
    labelled: DataFrame, assets: DataFrame, model: PairModel, run_time: datetime,
    stored: DataFrame | None = None,
) -> DataFrame:
    """Score labelled cross-kind pairs and keep those of one asset."""
    front, back = F.col("f_type") == "packet", F.col("b_type") == "packet"
    oriented = (
        labelled.withColumn("features", _features())
        .withColumn("f_ip", F.when(front, F.col("f_dst_ip")).otherwise(F.col("f_ip")))
        .withColumn("b_ip", F.when(back, F.col("b_src_ip")).otherwise(F.col("b_ip")))
        .drop("f_positions", "b_positions", "f_src_ip", "f_dst_ip", "b_src_ip", "b_dst_ip")
        .na.drop("any")
    )
    matched = stage(same_asset(oriented, assets), "asset-pairs")
    scored = score_features(model.fitted, matched).withColumn("ai_rmse_scaled", model.scaled("ai_rmse"))
    labelled = label(scored, "ai_rmse", model.threshold, "within").withColumn("version", at(run_time))
    result = conform(labelled, PAIR_RESULT)
    return result if stored is None else new_rows(result, stored, ["f_hash", "b_hash"])
