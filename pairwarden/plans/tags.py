"""Sensor tags: fit per unit type, score all types in one plan."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pairwarden.functions.columns import clean_value, conform, route_by_prefix
from pairwarden.functions.times import at
from pairwarden.operators.lookup import lookup_join
from pairwarden.operators.ordering import number_rows
from pairwarden.operators.reconstruct import Linear, fit_window_reconstructor, reconstruct_window
from pairwarden.operators.reshape import complete_rows, to_wide
from pairwarden.operators.scoring import (
    grouped_mad_threshold,
    label,
    minmax_apply,
    minmax_of,
    stable,
    window_mse,
)
from pairwarden.operators.sequence import keep_first, lookback
from pairwarden.plans.models import DenseModel
from pairwarden.schemas import TAG_PREPARED, TAG_RESULT
from pairwarden.session import stage
from pairwarden.sources.scan import scan_range
from pairwarden.sources.sinks import fit_history, new_rows

# Tag prefix, unit type, unit id, operating id; message id and label factor of results.
UNIT_PREFIXES = (
    ("T1", "Turbine1", "EWP_01_UN_01", "EWP_01_OI_01"),
    ("M1", "Turbine1", "EWP_01_UN_01", "EWP_01_OI_01"),
    ("TBN1", "Turbine1", "EWP_01_UN_01", "EWP_01_OI_01"),
    ("T2", "Turbine2", "EWP_01_UN_02", "EWP_01_OI_02"),
    ("M2", "Turbine2", "EWP_01_UN_02", "EWP_01_OI_02"),
    ("TBN2", "Turbine2", "EWP_01_UN_02", "EWP_01_OI_02"),
    ("BLR1", "Boiler1", "EWP_01_UN_01", "EWP_01_OI_01"),
    ("BLR2", "Boiler2", "EWP_01_UN_02", "EWP_01_OI_02"),
)
MESSAGE_ID = "I002"
LABEL_FACTOR = 10.0


@dataclass(frozen=True)
class TagFit:
    model: DenseModel
    validation: DataFrame
    history: DataFrame


def training_cells(readings: DataFrame, catalogue: DataFrame) -> DataFrame:
    """Sum per time and tag of the catalogue, for times at which every tag that occurs has a value.

    Long form: date_time, tag_name, type, v.
    """
    listed = catalogue.select("tag_name", "type").distinct()
    value = F.coalesce(clean_value("tag_value"), F.lit(0.0))
    cells = (
        lookup_join(readings, listed, ["tag_name"])
        .groupBy("date_time", "tag_name", "type")
        .agg(F.sum(value).alias("v"))
    )
    cells = stage(cells, "tag-cells")
    per_time = cells.groupBy("date_time").agg(F.countDistinct("tag_name").alias("n"))
    wanted = cells.select("tag_name").distinct().count()
    return cells.join(per_time.filter(F.col("n") == wanted).select("date_time"), "date_time")


def train_tags(
    readings: DataFrame, catalogue: DataFrame, unit_types: Sequence[str], start, end, run_time: datetime,
    steps: int = 1, k: int = 0, model_id: int = 5,
) -> dict[str, TagFit]:
    """Fit all unit types from one pass over the readings and label their training rows.

    Rows stay in long form: bounds, means and errors are aggregates per tag or per time. Only
    directions (``k`` > 0) need a matrix with a column per tag of one type.
    """
    spark = readings.sparkSession
    in_range = scan_range(readings, "date_time", start, end)
    cells = stage(
        training_cells(in_range, catalogue).filter(F.col("type").isin(list(unit_types))), "tag-training"
    )
    indexed, n = number_rows(cells.select("date_time").distinct(), ["date_time"])
    bounds = stage(
        cells.groupBy("type", "tag_name").agg(F.min("v").alias("lo"), F.max("v").alias("hi")), "tag-bounds"
    )
    span = F.when(F.col("hi") > F.col("lo"), F.col("hi") - F.col("lo")).otherwise(1.0)
    scaled = cells.join(bounds, ["type", "tag_name"]).join(indexed, "date_time").withColumn(
        "s", (F.col("v") - F.col("lo")) / span
    )
    # row i of a window, counted from its newest step, is the value ``back`` times earlier;
    # times without enough predecessors have windows of zeros, the last time has none
    inside = F.explode(F.sequence(F.lit(0), F.lit(steps - 1))).alias("back")
    terms = stage(
        scaled.select("type", "tag_name", "idx", "s", inside)
        .withColumn("i", F.col("idx") + F.col("back"))
        .filter((F.col("i") >= steps - 1) & (F.col("i") < n - 1)),
        "tag-windows",
    )
    means = stage(
        terms.groupBy("type", "tag_name", "back").agg((F.sum("s") / F.lit(max(n - 1, 1))).alias("mean")),
        "tag-means",
    )
    known = {(r.type, r.tag_name): (r.lo, r.hi) for r in bounds.collect()}  # one row per tag
    mean = {(r.type, r.tag_name, r.back): r["mean"] for r in means.collect()}
    error = terms.join(means, ["type", "tag_name", "back"]).groupBy("type", "i").agg(
        F.sum((F.col("s") - F.col("mean")) * (F.col("s") - F.col("mean"))).alias("e")
    )
    linears, scores = {}, []
    for unit_type in unit_types:
        cols = sorted(tag for kind, tag in known if kind == unit_type)
        linear = Linear([
            mean.get((unit_type, c, back), 0.0) for back in range(steps - 1, -1, -1) for c in cols
        ])
        if k:
            mine = cells.filter(F.col("type") == unit_type)
            linear, scored = _fit_directions(mine, cols, {c: known[unit_type, c] for c in cols}, steps, k)
        else:
            empty = sum(m * m for m in linear.means)
            places = indexed.filter(F.col("idx") < n - 1).join(
                error.filter(F.col("type") == unit_type), indexed["idx"] == F.col("i"), "left"
            )
            scored = places.select("date_time", stable(
                F.coalesce("e", F.lit(empty)) / F.lit(max(1, len(linear.means)))).alias("ai_rmse"))
        linears[unit_type] = (cols, linear)
        scores.append(scored.select(F.lit(unit_type).alias("type"), "date_time", "ai_rmse"))
    scored = stage(reduce(DataFrame.unionByName, scores), "tag-scores")
    # thresholds, error ranges and losses of all unit types at once, one row each
    limits = grouped_mad_threshold(scored, ["type"], "ai_rmse").select("type", "threshold")
    found = scored.groupBy("type").agg(
        F.count("*").alias("rows"), F.avg("ai_rmse").alias("loss"), F.min("ai_rmse").alias("lo"),
        F.max("ai_rmse").alias("hi"),
    ).join(limits, "type").collect()
    settings = {r.type: r for r in found}
    fits = {}
    for unit_type, (cols, linear) in linears.items():
        if unit_type not in settings:
            raise ValueError(f"no values of {unit_type}")
        mine = scored.filter(F.col("type") == unit_type).drop("type")
        fits[unit_type] = _tag_fit(
            spark, cells.filter(F.col("type") == unit_type), mine, settings[unit_type], cols,
            {c: known[unit_type, c] for c in cols}, linear, run_time, steps, model_id,
        )
    return fits


def _fit_directions(cells: DataFrame, cols: Sequence[str], bounds: dict, steps: int, k: int):
    """Directions of the windows of one unit type, and the training errors."""
    wide = complete_rows(to_wide(cells, "date_time", "tag_name", "v", cols))
    scaled = minmax_apply(wide, bounds)
    windows = stage(lookback(scaled, ["date_time"], cols, steps, inclusive=True), "tag-windows")
    linear = fit_window_reconstructor(windows, "window", k)
    restored = reconstruct_window(linear, windows, steps, len(cols))
    return linear, restored.select(
        "date_time", stable(window_mse(F.col("window"), F.col("window_hat"))).alias("ai_rmse")
    )


def _tag_fit(
    spark, cells: DataFrame, scored: DataFrame, fitted, cols, bounds, linear: Linear,
    run_time: datetime, steps: int, model_id: int,
) -> TagFit:
    error_range = (fitted.lo, fitted.hi)
    labelled = label(scored, "ai_rmse", fitted.threshold, "above").withColumn(
        "ai_rmse_scaled", minmax_of("ai_rmse", error_range)
    )
    validation = (
        cells.select("date_time", "tag_name", F.col("v").alias("tag_value"))
        .join(labelled, "date_time")
        .withColumn("version", at(run_time))
    )
    history = fit_history(
        spark, model_id, fitted.type, run_time, run_time, [fitted.loss], (fitted.rows, steps, len(cols))
    )
    return TagFit(DenseModel(list(cols), bounds, linear, fitted.threshold, error_range), validation, history)


def _tag_settings(readings: DataFrame, models: dict[str, DenseModel]) -> DataFrame:
    """One row per (unit type, tag): scaling, mean, weights, threshold, error range."""
    rows = []
    for unit_type, m in models.items():
        for i, tag in enumerate(m.cols):
            lo, hi = m.bounds[tag]
            weights = [c[i] for c in m.linear.components]
            rows.append(
                (unit_type, tag, lo, (hi - lo) or 1.0, m.linear.means[i], weights, len(m.cols),
                 m.threshold * LABEL_FACTOR, m.error_range[0], (m.error_range[1] - m.error_range[0]) or 1.0)
            )
    schema = (
        "unit_type string, tag_name string, _lo double, _span double, _mean double, "
        "_weights array<double>, _tags int, ai_threshold double, _from double, _range double"
    )
    return readings.sparkSession.createDataFrame(rows, schema)


@dataclass(frozen=True)
class TagScores:
    prepared: DataFrame
    result: DataFrame


def score_tags(
    readings: DataFrame, models: dict[str, DenseModel], start, end, run_time: datetime,
    prefixes: Sequence[tuple] = UNIT_PREFIXES, stored: DataFrame | None = None,
) -> TagScores:
    """Score each time of each unit type; rows stay in long form throughout.

    A time counts when all tags of its type are there. Its error is a sum over its
    tags, so no matrix with a column per tag is needed and types share one plan.
    """
    in_range = scan_range(readings, "date_time", start, end)
    routed = route_by_prefix(in_range, "tag_name", prefixes).distinct()
    first = keep_first(routed, ["tag_name", "date_time"], ["hash"])
    known = lookup_join(first, _tag_settings(readings, models), ["unit_type", "tag_name"])
    value = F.coalesce(clean_value("tag_value"), F.lit(0.0))
    per_time = Window.partitionBy("unit_type", "date_time").orderBy("tag_name").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    k = max((len(m.linear.components) for m in models.values()), default=0)
    rows = known.withColumn("_raw", value).withColumn("_x", (F.col("_raw") - F.col("_lo")) / F.col("_span"))
    rows = rows.withColumn("_d", F.col("_x") - F.col("_mean"))
    error = F.sum(F.col("_d") * F.col("_d")).over(per_time)
    for c in range(k):
        weight = F.coalesce(F.get("_weights", F.lit(c)), F.lit(0.0))
        along = F.sum(F.col("_d") * weight).over(per_time)
        error = error - along * along
    scored = (
        rows.withColumn("_present", F.count(F.lit(1)).over(per_time))
        .withColumn("ai_rmse", stable(F.greatest(error, F.lit(0.0)) / F.col("_tags")))
        .filter("_present = _tags")
        .withColumn("hash", F.concat_ws("_", "unit_type", "hash"))
        .withColumn("message_id", F.lit(MESSAGE_ID))
        .withColumn("trans_tag", F.col("unit_type"))
        .withColumn("time_line", F.col("date_time"))
        .withColumn("version", at(run_time))
    )
    prepared = conform(scored.withColumn("tag_value", F.col("_x")), TAG_PREPARED)
    result = (
        scored.withColumn("tag_value", F.col("_raw"))
        .withColumn("ai_rmse_scaled", (F.col("ai_rmse") - F.col("_from")) / F.col("_range"))
        .withColumn("ai_label", F.col("ai_rmse") > F.col("ai_threshold"))
    )
    result = conform(result, TAG_RESULT)
    return TagScores(prepared, result if stored is None else new_rows(result, stored, ["hash"]))
