"""Result tables: idempotent append, batch stamps, versions, fit history."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StructField, StructType

from pairwarden.functions.times import at
from pairwarden.operators.ordering import number_rows
from pairwarden.schemas import FIT_HISTORY
from pairwarden.session import stage, staged_scope
from pairwarden.sources.versions import load_version, publish


def new_rows(df: DataFrame, stored: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct rows of ``df`` whose key is not stored yet.

    Rows of one batch may share a key (many tags per time): they all pass.
    """
    known = stored.select(*keys).distinct()
    return df.distinct().join(known, list(keys), "left_anti")


DAY = "day"


def read_stored(spark: SparkSession, path: str, like: DataFrame, days: Sequence | None = None) -> DataFrame:
    """The stored table, or an empty one of the same schema before the first write.

    ``days`` limits a table that is partitioned by day to those days; others are not read.
    """
    schema = like.schema
    if days is not None:
        schema = StructType([*schema.fields, StructField(DAY, DateType())])
    try:
        stored = spark.read.schema(schema).parquet(path)
    except AnalysisException as missing:
        if "PATH_NOT_FOUND" not in str(missing):
            raise
        return like.limit(0)
    return stored if days is None else stored.filter(F.col(DAY).isin(list(days))).drop(DAY)


def append_new(df: DataFrame, path: str, keys: Sequence[str], time: str | None = None) -> None:
    """Append the rows that ``new_rows`` lets through; repeating it adds nothing.

    With ``time``, a column that is the same for all rows of a key, the table is
    partitioned by its day, and only the days of the new rows are read again. A large table
    without such a column is better a ``KeyedStore``: without ``time`` all stored keys are read.
    """
    spark = df.sparkSession
    if time is None:
        new_rows(df, read_stored(spark, path, df), keys).write.mode("append").parquet(path)
        return
    with staged_scope(spark):
        fresh = stage(df.distinct(), "append")
        day = F.to_date(F.col(time))
        days = [r[0] for r in fresh.select(day).distinct().collect()]  # the days of one run
        known = read_stored(spark, path, fresh, [d for d in days if d is not None])
        new_rows(fresh, known, keys).withColumn(DAY, day).write.mode("append").partitionBy(DAY).parquet(path)


def with_batch_no(df: DataFrame, order: Sequence[str], rows: int = 1000) -> DataFrame:
    """Number the batches of ``rows`` rows in which a table is stored."""
    numbered, _ = number_rows(df, order)
    return numbered.withColumn("batch_no", F.expr(f"idx div {rows}")).drop("idx")


def stamp_batches(df: DataFrame, start: Column) -> DataFrame:
    """Version of each row: the write time of its batch, one second after the one before."""
    return df.withColumn("version", start + F.expr("make_dt_interval(0, 0, 0, batch_no)"))


_ROWS = "rows"


def save_snapshot(df: DataFrame, root: str, version: str) -> None:
    """Publish a training set as a version; saving a version again replaces it, all at once."""
    publish({_ROWS: df}, root, version, replace=True)


def load_snapshot(spark: SparkSession, root: str, version: str) -> DataFrame:
    """The training set of a complete version."""
    return load_version(spark, root, version)[_ROWS]


def latest_version(versions: DataFrame, now: datetime, n_files: int, by: Sequence[str] = ()) -> DataFrame:
    """Newest complete version that is not later than ``now`` (per ``by`` group)."""
    usable = versions.filter(
        (F.col("version") <= at(now)) & (F.col("n_files") == n_files)
    )
    return usable.groupBy(*by).agg(F.max("version").alias("version"))


def fit_history(
    spark: SparkSession,
    model_id: int,
    model_type: str,
    train_time: datetime,
    validation_time: datetime,
    losses: Sequence[float],
    data_shape: Sequence[int],
) -> DataFrame:
    """One row per fitted component count, ready to be appended to the history table."""
    shape = str(tuple(data_shape))
    rows = [
        (model_id, model_type, train_time, validation_time, train_time, float(loss), step, shape)
        for step, loss in enumerate(losses, start=1)
    ]
    return spark.createDataFrame(rows, FIT_HISTORY)
