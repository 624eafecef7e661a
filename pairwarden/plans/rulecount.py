"""Rule-count anomaly per 10-minute bucket and similarity of the events in it."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairwarden.functions.columns import conform, demote, different_site, site, text_of
from pairwarden.functions.times import at, bucket
from pairwarden.operators.autoencoder import Training, fit_network, score_network
from pairwarden.operators.features import rule_space
from pairwarden.operators.joins import attach_multi
from pairwarden.operators.reconstruct import Linear, reconstruct
from pairwarden.operators.reshape import count_matrix, stack
from pairwarden.operators.rules import load_rules, rules_in_use, select_rules
from pairwarden.operators.scoring import label, mad_threshold, minmax_fit, row_rmse, stable
from pairwarden.operators.similarity import bag_rows, named_links, similar_pairs
from pairwarden.plans.models import DenseModel
from pairwarden.schemas import SIMILAR_RESULT
from pairwarden.session import stage
from pairwarden.sources.sinks import fit_history, new_rows

# Columns that make up the text of an event, the label threshold, model ids.
TEXT_COLS = {
    "log": ("msg", "value01", "value02", "value03", "type01"),
    "packet": ("protocol_type", "protocol_detail", "anomaly_type"),
}
SIMILARITY_THRESHOLD = 0.99
MODEL_IDS = {"log": 3, "packet": 4}


def train_rule_space(
    spark: SparkSession, rules: DataFrame, mapping: DataFrame, kind: int, name: str,
    run_time: datetime, hidden: Sequence[tuple[int, str]] | None = None, how: Training = Training(),
) -> tuple[DenseModel, DataFrame]:
    """Model over all 0/1 combinations of the rules in use: (model, history).

    With ``hidden`` layers a network is fitted to the combinations, which are a lazy range;
    its errors give the threshold and the range, and the history has the loss of each epoch.

    Without, the model is the column means. Over all combinations every mean is 1/2, and every
    combination is as far from the means: each has the error 1/2, which is also the threshold
    and the whole range; no direction explains more than another, so this is known without a
    fit. A bucket is then anomalous exactly when its counts are further from 1/2 than 0 and 1
    are: when a rule hits twice.
    """
    used = load_rules(rules_in_use(select_rules(rules, kind), mapping))
    if not used:
        raise ValueError(f"no {name} rule occurs in a multi-rule")
    cols = [f"r{r.rule_id}" for r in used]
    shape = (8 * (1 << len(cols)), len(cols))
    if hidden is None:
        history = fit_history(spark, MODEL_IDS[name], name, run_time, run_time, [0.5], shape)
        return DenseModel(cols, {}, Linear([0.5] * len(cols)), 0.5, (0.5, 0.5)), history
    space = rule_space(spark, [r.rule_id for r in used])
    rows = space.select(F.array(*[F.col(c).cast("double") for c in cols]).alias("features"))
    network, losses, _ = fit_network(rows, hidden=hidden, last="sigmoid", how=how)
    scored = stage(score_network(network, rows, sparse=False).select("ai_rmse"), "space-scores")
    history = fit_history(spark, MODEL_IDS[name], name, run_time, run_time, losses, shape)
    error_range = minmax_fit(scored, ["ai_rmse"])["ai_rmse"]
    return DenseModel(cols, {}, network, mad_threshold(scored, "ai_rmse"), error_range), history


def score_counts_matrix(linear, matrix: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Reconstruction error of each row of a count matrix."""
    restored = reconstruct(linear, matrix, cols)
    return restored.withColumn("ai_rmse", stable(row_rmse(F.col("x"), F.col("xhat")))).drop("x", "xhat")


def bucket_scores(events: DataFrame, model: DenseModel, time: str = "time") -> DataFrame:
    """Score and label of each 10-minute bucket; training saw 0/1, scoring sees counts."""
    rules = [int(c[1:]) for c in model.cols]
    matrix = count_matrix(events, time, "single_rule", rules)
    scored = score_counts_matrix(model.linear, matrix, model.cols)
    return label(scored, "ai_rmse", model.threshold, "above")


_EVENT_COLS = ["time", "ip", "type", "single_rule", "hash", "id", "milli_time"]


def _anomalous(events: DataFrame, model: DenseModel, kind: str) -> DataFrame:
    """Events of anomalous buckets with their texts."""
    texts = stage(events.select(*_EVENT_COLS, text_of(TEXT_COLS[kind]).alias("text")), f"{kind}-texts")
    marked = bucket_scores(texts, model).filter("ai_label").select("bucket", "ai_rmse", "ai_label")
    return texts.withColumn("bucket", bucket("time")).join(marked, "bucket").withColumn("_rule", F.col("single_rule"))


def similar_event_classes(
    events: DataFrame, model: DenseModel, kind: str, min_sim: float = SIMILARITY_THRESHOLD
) -> DataFrame:
    """The similar events, equal ones in a space that grows with the events: bucket, single_rule, part,
    f_hash, b_hash, site, cos_sim.

    Events of a bucket and rule with the same words are a class, named by its smallest hash. Part
    ``member`` has a row per event: its class (f_hash), itself (b_hash) and its site. Part ``link``
    has two classes and their similarity. Two events are a pair of ``similar_events`` exactly when
    their sites differ and they are of one class or of linked ones. Classes and links without
    two sites are left out.

    At a low bound most classes of a bucket are linked, and links grow with the square of its classes.
    They are not staged: they leave the tasks as rows of the result.
    """
    place = F.array_join(site(F.col("id")), "_")
    raw = _anomalous(events, model, kind).select("bucket", "_rule", "type", "hash", place.alias("site"), "text")
    group = ["bucket", "_rule", "type"]
    rows = bag_rows(raw, "text")
    members = rows.filter("bag is not null").drop("_words", "_asked")
    classes = members.groupBy(*group, "bag").agg(
        F.min("hash").alias("name"), F.min("site").alias("lo"), F.max("site").alias("hi"))
    links, degrees = named_links(rows, group, min_sim, F.min("hash"), "site")
    kept = classes.join(degrees, [*group, "bag"], "left").filter("lo <> hi or n_links is not null")
    members = members.join(kept.select(*group, "bag", "name"), [*group, "bag"]).select(
        "bucket", F.col("_rule").alias("single_rule"), F.lit("member").alias("part"), F.col("name").alias("f_hash"),
        F.col("hash").alias("b_hash"), "site", F.lit(1.0).alias("cos_sim"))
    return members.unionByName(links.select(
        "bucket", F.col("_rule").alias("single_rule"), F.lit("link").alias("part"),
        F.least("a_name", "b_name").alias("f_hash"), F.greatest("a_name", "b_name").alias("b_hash"),
        F.lit(None).cast("string").alias("site"), F.col("sim").alias("cos_sim")))


def similar_events(
    events: DataFrame, model: DenseModel, kind: str, min_sim: float = 0.0
) -> DataFrame:
    """Similar events of different sites and one rule inside anomalous buckets, pair by pair.

    A burst of m equal events makes about m x m pairs; ``similar_event_classes`` does not.
    """
    raw = _anomalous(events, model, kind)
    cols = [*_EVENT_COLS, "ai_rmse", "ai_label"]
    place = F.array_join(site(F.col("id")), "_")
    pairs = similar_pairs(raw, ["bucket", "_rule"], "hash", cols, "text", min_sim, apart=place)
    return (
        pairs.filter(different_site("f_id", "b_id") & (F.col("f_type") == F.col("b_type")))
        .withColumnsRenamed({"f_ai_rmse": "ai_rmse", "f_ai_label": "ai_label", "sim": "cos_sim"})
        .drop("b_ai_rmse", "b_ai_label", "bucket", "_rule")
    )


def predict_bucket_similarity(
    events: dict[str, DataFrame], models: dict[str, DenseModel], mapping: DataFrame,
    run_time: datetime, min_sim: float | None = None, threshold: float = SIMILARITY_THRESHOLD,
    stored: DataFrame | None = None,
) -> DataFrame:
    """Similarity results of all kinds with multi-rule ids and demoted labels.

    Only pairs above the threshold, which stay labelled True, are looked for. A smaller
    ``min_sim`` also gives the pairs down to it, labelled False; 0 gives every pair that
    shares a word, and their number grows with the square of a bucket.
    """
    min_sim = threshold if min_sim is None else min_sim
    found = stack([similar_events(events[kind], models[kind], kind, min_sim) for kind in events])
    labelled = demote(attach_multi(found, mapping), "cos_sim", threshold)
    result = conform(labelled.withColumn("version", at(run_time)), SIMILAR_RESULT).distinct()
    return result if stored is None else new_rows(result, stored, ["f_hash", "b_hash"])
