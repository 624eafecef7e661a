"""Log-log correlation: training and prediction."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairwarden.functions.columns import conform, label_by_rule
from pairwarden.functions.times import at
from pairwarden.operators.autoencoder import Training
from pairwarden.operators.features import onehot_apply, onehot_fit
from pairwarden.operators.joins import label_pairs
from pairwarden.operators.reconstruct import score_features
from pairwarden.operators.rules import LOG, load_rules, same_kind_pairs, select_rules
from pairwarden.operators.scoring import label
from pairwarden.operators.sequence import adjacent_pairs, skip_pairs, split_pairs
from pairwarden.plans.correlation import Fitted, Tables, fit_pair_model
from pairwarden.plans.events import enrich_logs, log_hits, pair_rows, without_source
from pairwarden.plans.models import PairModel
from pairwarden.schemas import SAME_KIND_RESULT
from pairwarden.session import stage

# Fixed value: score up to which a log pair counts as a known pattern.
FIXED_THRESHOLD = 0.017396


def _logs(tables: Tables, start, end, exclusion_source: str | None) -> DataFrame:
    rules = load_rules(select_rules(tables.rules, LOG, active_only=True))
    hits = log_hits(tables.logs, rules, start, end)
    if exclusion_source:
        hits = without_source(hits, exclusion_source)
    return enrich_logs(hits, tables.devices)


def _features(size: int):
    """Front part, then back part."""
    empty = F.array().cast("array<long>")
    back = F.transform("b_positions", lambda p: p + size)
    return F.concat(F.coalesce("f_positions", empty), F.coalesce(back, empty))


def train_same_kind(
    tables: Tables, log_cols: Sequence[str], start, end, run_time: datetime, skip_n: int = 1,
    k: int = 0, balanced: bool = True, model_id: int = 2, exclusion_source: str | None = None,
    seed: int | None = None, hidden: Sequence[tuple[int, str]] | None = None, how: Training = Training(),
) -> Fitted:
    """Fit the pair model on log pairs of a common multi-rule.

    Balancing adds its draws to the pairs themselves.
    """
    logs = _logs(tables, start, end, exclusion_source)
    logs = stage(logs.select("type", "single_rule", "hash", "time_text", *log_cols), "train-logs")
    encoder = onehot_fit(logs, log_cols)
    rows = pair_rows([onehot_apply(encoder, logs)], ["positions"])
    cols = ["type", "single_rule", "hash", "positions"]
    pairs = skip_pairs(rows, ["time_text", "hash", "single_rule"], cols, skip_n)
    labelled = label_pairs(pairs, same_kind_pairs(tables.mapping)).withColumn(
        "features", _features(encoder.size)
    )
    train, held = split_pairs(
        stage(labelled.drop("f_positions", "b_positions"), "train-pairs"), cross_only=False
    )
    return fit_pair_model(
        train, held, {"log": encoder}, 2 * encoder.size, k, model_id, run_time, balanced,
        keep_original=True, seed=seed, hidden=hidden, how=how,
    )


def predict_same_kind(
    tables: Tables, model: PairModel, start, end, run_time: datetime,
    threshold: float = FIXED_THRESHOLD, exclusion_source: str | None = None,
) -> DataFrame:
    """Scored adjacent log pairs; the label finally follows the multi-rule id."""
    logs = _logs(tables, start, end, exclusion_source)
    encoder = model.encoders["log"]
    rows = pair_rows([onehot_apply(encoder, logs)], ["positions"])
    cols = ["time", "ip", "type", "single_rule", "hash", "id", "positions"]
    pairs = adjacent_pairs(rows, ["time_text", "hash", "single_rule"], cols)
    labelled = label_pairs(pairs, same_kind_pairs(tables.mapping)).withColumn(
        "corr", F.coalesce("corr", F.lit(0).cast("long"))
    )
    labelled = stage(labelled.withColumn("features", _features(encoder.size)), "log-pairs")
    scored = score_features(model.fitted, labelled)
    scored = label(scored, "ai_rmse", threshold, "within").withColumn(
        "ai_rmse_scaled", model.scaled("ai_rmse")
    )
    result = label_by_rule(scored).withColumn("version", at(run_time))
    return conform(result, SAME_KIND_RESULT).distinct()
