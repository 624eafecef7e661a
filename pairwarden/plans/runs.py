"""Whole prediction runs: newest model, prediction, append of what is new.

Results are kept by day below a folder, one table per kind of result; a run reads the days
of its range only, and repeating it adds nothing.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairwarden.plans import correlation, rulecount, samekind, tags
from pairwarden.plans.models import (
    DENSE_MODEL_FILES,
    PAIR_MODEL_FILES,
    load_dense_models,
    load_pair_model,
)
from pairwarden.sources.sinks import DAY, append_new, latest_version
from pairwarden.sources.versions import list_versions


class NoModelError(LookupError):
    """No complete model version up to the run time."""


def newest(spark: SparkSession, root: str, run_time: datetime, n_files: int) -> datetime:
    found = latest_version(list_versions(spark, root), run_time, n_files).first()
    if found is None or found.version is None:
        raise NoModelError(f"no complete version at {root} up to {run_time}")
    return found.version


def store_history(history: DataFrame, results: str) -> None:
    """Append the fit history of a training."""
    append_new(history, f"{results}/fit_history", ["model_id", "model_type", "version", "epoch"])


def _stored(spark: SparkSession, path: str, start, end) -> DataFrame | None:
    """Stored rows of the days of a run, None before the first one."""
    files = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = files.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not system.exists(files):
        return None
    first, last = ((v if isinstance(v, datetime) else datetime.fromisoformat(v)).date() for v in (start, end))
    return spark.read.parquet(path).filter(F.col(DAY).between(first, last + timedelta(days=1))).drop(DAY)


def run_correlation(
    tables: correlation.Tables, settings: correlation.CorrelationSettings, models: str, results: str,
    start, end, run_time: datetime,
) -> None:
    """Log-packet prediction: single events, prepared events and pairs."""
    spark = tables.logs.sparkSession
    model = load_pair_model(spark, models, newest(spark, models, run_time, PAIR_MODEL_FILES))
    paths = {name: f"{results}/{name}" for name in ("single_logs", "single_packets", "prepared", "pairs")}
    kept = {name: _stored(spark, path, start, end) for name, path in paths.items()}
    singles = [kept[n].select("hash") for n in ("single_logs", "single_packets") if kept[n] is not None]
    stored = correlation.Stored(
        singles[0].unionByName(singles[-1]) if singles else None, kept["prepared"], kept["pairs"]
    )
    found = correlation.predict_correlation(tables, settings, model, start, end, run_time, stored)
    append_new(found.single_logs, paths["single_logs"], ["hash", "single_rule", "ip"], "time")
    append_new(found.single_packets, paths["single_packets"], ["hash", "single_rule", "ip"], "time")
    append_new(found.prepared, paths["prepared"], ["hash", "single_rule", "ip"], "time")
    append_new(found.pairs, paths["pairs"], ["f_hash", "b_hash"], "f_time")


def run_same_kind(
    tables: correlation.Tables, models: str, results: str, start, end, run_time: datetime,
    exclusion_source: str | None = None,
) -> None:
    """Log-log prediction."""
    spark = tables.logs.sparkSession
    model = load_pair_model(spark, models, newest(spark, models, run_time, PAIR_MODEL_FILES))
    found = samekind.predict_same_kind(
        tables, model, start, end, run_time, exclusion_source=exclusion_source
    )
    append_new(found, f"{results}/log_pairs", ["f_hash", "b_hash"], "f_time")


def run_bucket_similarity(
    events: dict[str, DataFrame], mapping: DataFrame, models: str, results: str, run_time: datetime
) -> None:
    """Similar events of anomalous buckets; there is one model per kind of event."""
    spark = mapping.sparkSession
    version = newest(spark, models, run_time, DENSE_MODEL_FILES * len(events))
    found = rulecount.predict_bucket_similarity(
        events, load_dense_models(spark, models, version), mapping, run_time
    )
    append_new(found, f"{results}/similar", ["f_hash", "b_hash"], "f_time")


def run_tags(
    readings: DataFrame, n_types: int, models: str, results: str, start, end, run_time: datetime,
    prefixes=tags.UNIT_PREFIXES,
) -> None:
    """Tag prediction with one model per unit type."""
    spark = readings.sparkSession
    version = newest(spark, models, run_time, DENSE_MODEL_FILES * n_types)
    scores = tags.score_tags(
        readings, load_dense_models(spark, models, version), start, end, run_time, prefixes
    )
    append_new(scores.prepared, f"{results}/tag_prepared", ["hash"], "date_time")
    append_new(scores.result, f"{results}/tag_result", ["hash"], "date_time")
