"""Rule matching, rule counts and de-duplication on streams."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from pairwarden.operators.rule_index import match_rules_indexed
from pairwarden.operators.rules import Rule, match_rules
from pairwarden.session import fresh_path, stage, staged_scope
from pairwarden.sources.keyed_store import KeyedStore
from pairwarden.sources.sinks import append_new


def read_stream(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A Parquet table, one file or a folder of part files, as a stream; the schema is declared.

    A path that does not exist is an error, not an empty stream.
    """
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    reader = spark.readStream.schema(schema)
    if not files.getFileStatus(target).isDirectory():  # a stream source is a folder: take this file of it
        reader = reader.option("pathGlobFilter", target.getName())
        path = target.getParent().toString()
    return reader.parquet(path)


def stream_match_rules(stream: DataFrame, rules: list[Rule], time: str = "ts") -> DataFrame:
    """The batch rule match on a stream (stateless)."""
    return match_rules(stream, rules, time)


def stream_match_rules_indexed(stream: DataFrame, rules: list[Rule], time: str = "ts") -> DataFrame:
    """The indexed rule match on a stream (stateless), for rules by the thousand."""
    return match_rules_indexed(stream, rules, time)


def _watermarked(df: DataFrame, time: str, delay: str) -> DataFrame:
    # watermarks need a zoned timestamp; the session runs in UTC
    return df.withColumn("_at", F.col(time).cast("timestamp")).withWatermark("_at", delay)


def stream_rule_counts(
    stream: DataFrame, rule: str, time: str = "ts", delay: str = "10 minutes", width: str = "10 minutes"
) -> DataFrame:
    """Hits per closed bucket and rule, in long form."""
    return (
        _watermarked(stream, time, delay)
        .groupBy(F.window("_at", width).alias("w"), F.col(rule))
        .agg(F.count(F.lit(1)).alias("n"))
        .select(F.col("w.start").cast("timestamp_ntz").alias("bucket"), rule, "n")
    )


def stream_dedup(stream: DataFrame, keys: Sequence[str] = ("hash",), time: str = "ts", delay: str = "1 hour") -> DataFrame:
    """First row per key among those that arrive within the delay of each other."""
    return _watermarked(stream, time, delay).dropDuplicatesWithinWatermark(list(keys)).drop("_at")


def stream_append_new(
    stream: DataFrame, path: str, checkpoint: str, keys: Sequence[str], time: str | None = None,
    wait: int | None = None, buckets: int | None = None,
) -> None:
    """Append what is new of a stream; a restart or a repeated batch adds nothing twice.

    ``keys`` must tell rows apart: rows of one key may lie in different batches, and the
    later ones would count as stored. A batch with two rows of one key is an error.
    ``time`` keeps the table by day, see ``append_new``. With ``buckets`` it is a ``KeyedStore`` of
    so many buckets, which is neither read nor shuffled whole. What a batch stages goes when
    the batch ends.
    """

    def store(batch: DataFrame, _: int) -> None:
        spark = batch.sparkSession
        with staged_scope(spark):
            fresh = stage(batch.distinct(), "batch")
            if not fresh.groupBy(*keys).count().filter("count > 1").isEmpty():
                raise ValueError(f"{list(keys)} do not tell the rows of a stream apart")
            if buckets is None:
                append_new(fresh, path, keys, time)
            else:
                KeyedStore(spark, path, tuple(keys), buckets).append_new(fresh)

    query = (
        stream.writeStream.option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(store)
        .start()
    )
    _finish(query, wait)


def run_available(stream: DataFrame, name: str, wait: int | None = None) -> DataFrame:
    """Process what is available into a fresh table of the shared folder and read it."""
    spark = stream.sparkSession
    out = fresh_path(spark, name)
    query = (
        stream.writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", fresh_path(spark, f"{name}-progress"))
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    _finish(query, wait)
    return spark.read.schema(stream.schema).parquet(out)


def _finish(query, wait: int | None) -> None:
    """Wait to the end, or at most ``wait`` seconds if a caller sets a limit."""
    if wait is None:
        query.awaitTermination()
    elif not query.awaitTermination(wait):
        query.stop()
        raise TimeoutError(f"stream did not finish within {wait} s")
    if query.exception():
        raise query.exception()
