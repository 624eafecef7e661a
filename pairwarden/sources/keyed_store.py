"""A large result table that is appended to by key, without reading or shuffling what it holds.

Rows are kept in buckets of their key, sorted, as a bucketed Parquet table; the side of a join
that is the store needs no exchange. Each file has a row in a sidecar table with a Bloom filter
of its keys. An append asks the filters first: a row whose key is in no file of its bucket is
new. Only the others, repeats and a few chance hits, are compared with the store, and only
with the files whose filter knows one of them; other files are not opened.

The table is a folder: ``rows`` (bucket files), ``filters`` (sidecars) and ``shape`` (keys and number of
buckets, which later sessions must share). Nothing outside the folder describes it. Key columns
must not be null. One writer at a time; a writer that fails leaves files without a sidecar,
which the next append completes before it compares.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from pairwarden.session import ship_package, stage, staged_scope

BITS_A_KEY = 16  # about one chance hit in two thousand
_PROBES = 8
_FILTERS = "file string, bucket int, keys long, bits binary"


def _positions(hashes: np.ndarray, size: int) -> np.ndarray:
    """Bit positions of each key (keys x probes) in a filter of ``size`` bits."""
    h = hashes.view(np.uint64)
    step = (h >> np.uint64(33)) | np.uint64(1)
    probes = np.arange(_PROBES, dtype=np.uint64)[:, None]
    return ((h + probes * step) % np.uint64(size)).T


def build_filter(hashes: np.ndarray) -> bytes:
    size = max(64, -(-len(hashes) * BITS_A_KEY // 8) * 8)
    bits = np.zeros(size, np.uint8)
    bits[_positions(hashes, size)] = 1
    return np.packbits(bits).tobytes()


def may_hold(bits: bytes, hashes: np.ndarray) -> np.ndarray:
    held = np.unpackbits(np.frombuffer(bits, np.uint8))
    return held[_positions(hashes, len(held))].all(axis=1)


def _file_filter(part: pa.Table) -> pa.Table:
    """One sidecar row of a file's keys."""
    hashes = np.unique(part["_key"].to_numpy())
    return pa.table({
        "file": part["file"][:1], "bucket": pa.array([part["bucket"][0].as_py()], pa.int32()),
        "keys": pa.array([len(hashes)], pa.int64()), "bits": pa.array([build_filter(hashes)], pa.binary()),
    })


def _suspects(asked: pa.Table, filters: pa.Table) -> pa.Table:
    """(key, file) for each asked key of a bucket that a file's filter knows."""
    keys = asked["_key"].to_numpy()
    found = [(keys[may_hold(bits, keys)], name) for name, bits in
             zip(filters["file"].to_pylist(), filters["bits"].to_pylist(), strict=True)] if len(keys) else []
    return pa.table({
        "_key": pa.array(np.concatenate([np.empty(0, np.int64), *[k for k, _ in found]])),
        "file": pa.array([name for k, name in found for _ in range(len(k))], pa.string()),
    })


@dataclass(frozen=True)
class KeyedStore:
    """The store at ``path``; ``buckets`` counts for a new one only."""

    spark: SparkSession
    path: str
    keys: tuple[str, ...]
    buckets: int = 64

    # -- layout --

    def _stored_shape(self):
        try:
            return self.spark.read.schema("keys array<string>, buckets int, columns string").parquet(
                f"{self.path}/shape").first()
        except AnalysisException as missing:
            if "PATH_NOT_FOUND" not in str(missing):
                raise
            return None

    def _table(self, like: StructType | None = None) -> tuple[str, StructType, int] | None:
        """(name of a table over the files, its columns, buckets); made for the session, dropped by no one."""
        ship_package(self.spark)
        shape = self._stored_shape()
        if shape is None:
            if like is None:
                return None
            self.spark.createDataFrame(
                [(list(self.keys), self.buckets, like.json())], "keys array<string>, buckets int, columns string"
            ).coalesce(1).write.parquet(f"{self.path}/shape")
            shape = self._stored_shape()
        if tuple(shape["keys"]) != self.keys:
            raise ValueError(f"the store at {self.path} is kept by {shape['keys']}, not {list(self.keys)}")
        columns = StructType.fromJson(json.loads(shape.columns))
        name = f"keyed_{uuid.uuid5(uuid.NAMESPACE_URL, self.path).hex}"
        fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in columns.fields)
        keys = ", ".join(f"`{c}`" for c in self.keys)
        location = f"{self.path}/rows".replace("'", "\\'")
        self.spark.sql(
            f"create table if not exists {name} ({fields}) using parquet clustered by ({keys}) sorted by ({keys})"
            f" into {shape.buckets} buckets location '{location}'"
        )
        self.spark.catalog.refreshTable(name)
        return name, columns, shape.buckets

    def read(self) -> DataFrame:
        found = self._table()
        if found is None:
            raise LookupError(f"no store at {self.path}")
        return self.spark.table(found[0])

    def _key(self) -> Column:
        return F.xxhash64(*[F.col(f"`{c}`") for c in self.keys])

    def _bucket(self, buckets: int) -> Column:
        """The bucket Spark keeps a row in."""
        return F.pmod(F.hash(*[F.col(f"`{c}`") for c in self.keys]), F.lit(buckets))

    # -- filters --

    def filters(self) -> DataFrame:
        try:
            return self.spark.read.schema(_FILTERS).parquet(f"{self.path}/filters")
        except AnalysisException as missing:
            if "PATH_NOT_FOUND" not in str(missing):
                raise
            return self.spark.createDataFrame([], _FILTERS)

    def complete_filters(self) -> None:
        """Sidecar rows for files that have none; reads those files only."""
        name, _, buckets = self._table()
        known = [r.file for r in self.filters().select("file").collect()]  # a row per file
        rows = self.spark.table(name).withColumn("file", F.col("_metadata.file_path"))
        new = rows.filter(~F.col("_metadata.file_path").isin(known)) if known else rows
        keys = new.select("file", self._bucket(buckets).cast("int").alias("bucket"), self._key().alias("_key"))
        keys.groupBy("file").applyInArrow(_file_filter, _FILTERS).write.mode("append").parquet(f"{self.path}/filters")

    # -- appending --

    def new_rows(self, df: DataFrame) -> DataFrame:
        """Distinct rows of ``df`` whose key is not stored yet. Rows of one batch may share a key."""
        return self._new(stage(df.distinct(), "append"))

    def _new(self, fresh: DataFrame) -> DataFrame:
        found = self._table()
        if found is None:
            return fresh
        name, _, buckets = found
        asked = fresh.select(self._bucket(buckets).cast("int").alias("bucket"), self._key().alias("_key")).distinct()
        matched = stage(
            asked.groupBy("bucket").cogroup(self.filters().groupBy("bucket")).applyInArrow(
                _suspects, "_key long, file string"),
            "suspects",
        )
        files = [r.file for r in matched.select("file").distinct().collect()]  # at most a row per file
        if not files:
            return fresh
        doubtful = matched.select("_key").distinct()
        keyed = fresh.withColumn("_key", self._key())
        clear = keyed.join(doubtful, "_key", "left_anti").drop("_key")
        suspects = keyed.join(doubtful, "_key", "left_semi").drop("_key")
        held = self.held(name, files)
        return clear.unionByName(suspects.join(held.hint("merge"), list(self.keys), "left_anti"))

    def held(self, name: str, files: Sequence[str]) -> DataFrame:
        """Keys of some files, still in their buckets."""
        return self.spark.table(name).filter(F.col("_metadata.file_path").isin(list(files))).select(*self.keys)

    def append_new(self, df: DataFrame) -> None:
        """Append what ``new_rows`` lets through; repeating it adds nothing."""
        with staged_scope(self.spark):
            fresh = stage(df.distinct(), "append")
            if self._table() is not None:
                self.complete_filters()  # of a writer that failed
            added = stage(self._new(fresh), "appended")
            name, columns, buckets = self._table(df.schema)
            if added.isEmpty():
                return
            ordered = added.select(*columns.names).repartition(buckets, *[F.col(f"`{c}`") for c in self.keys])
            ordered.sortWithinPartitions(*self.keys).write.mode("append").insertInto(name)
            self.complete_filters()
