"""Versions of training sets and models, published by a commit log.

A version is a few tables. They are written to a folder of their own that nothing refers to
yet; then one manifest with their files, row counts and checksums is put into the log by a rename
that fails if the name is taken. Before it a version does not exist, whatever a writer that
stopped midway has left; after it the version is complete. Of writers that publish the same
version at the same time one wins, the others get ``VersionTaken``. A version can be replaced:
its next revision is another manifest, and readers that hold the old one keep its files.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping
from datetime import datetime

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

MANIFEST = (
    "version string, time string, revision int, n_files int, tables array<struct<name:string, path:string, "
    "files:array<struct<name:string, bytes:long>>, rows:long, checksum:string, columns:string>>"
)


class VersionTaken(FileExistsError):
    """Another writer has published this version."""


class VersionMissing(LookupError):
    """No such version in the log."""


class VersionDamaged(ValueError):
    """Stored files are not what the manifest says."""


def _files(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _publish_file(spark: SparkSession, path: str, text: str) -> None:
    """Put a file at a path where there is none, whole or not at all."""
    jvm, conf = spark._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    target, system = _files(spark, path)
    draft = jvm.org.apache.hadoop.fs.Path(target.getParent(), f".{target.getName()}.{uuid.uuid4().hex}")
    stream = system.create(draft)
    stream.write(bytearray(text.encode()))
    stream.close()
    rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    how = spark.sparkContext._gateway.new_array(rename, 1)
    how[0] = rename.NONE  # never over another file
    try:
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), conf).rename(draft, target, how)
    except Py4JJavaError as failed:
        system.delete(draft, False)
        if "FileAlreadyExists" not in str(failed.java_exception.getClass().getName()):
            raise
        raise VersionTaken(path) from failed


def _checksum(df: DataFrame) -> tuple[int, str]:
    """Rows, and a sum over all rows that does not depend on their order."""
    row = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]).cast("decimal(38,0)")
    found = df.agg(F.count("*").alias("n"), F.sum(row).alias("s")).first()
    return found.n, str(found.s or 0)


def _listed(spark: SparkSession, path: str) -> list[dict]:
    folder, system = _files(spark, path)
    return sorted(
        ({"name": f.getPath().getName(), "bytes": f.getLen()} for f in system.listStatus(folder)
         if f.getPath().getName()[0] not in "._"),
        key=lambda f: f["name"],
    )


def label_of(version: datetime | str) -> str:
    return version if isinstance(version, str) else f"{version:%Y%m%d_%H}"


def manifests(spark: SparkSession, root: str) -> DataFrame:
    """All manifests of a log, newest revision of each version only."""
    try:
        found = spark.read.schema(MANIFEST).json(f"{root}/log")
    except AnalysisException as missing:
        if "PATH_NOT_FOUND" not in str(missing):
            raise
        return spark.createDataFrame([], MANIFEST)
    last = found.groupBy("version").agg(F.max("revision").alias("revision"))
    return found.join(last, ["version", "revision"]).select(*found.columns)


def publish(
    tables: Mapping[str, DataFrame], root: str, version: datetime | str, n_files: int | None = None,
    replace: bool = False,
) -> None:
    """Write the tables of a version and make it visible at once.

    ``n_files`` is the number of artefacts it stands for, as many as tables unless told.
    ``VersionTaken`` if the version is there and not to be replaced, or a writer was faster.
    """
    spark = next(iter(tables.values())).sparkSession
    label = label_of(version)
    own = manifests(spark, root).filter(F.col("version") == label)
    last = own.agg(F.max("revision")).first()[0]
    if last is not None and not replace:
        raise VersionTaken(f"{root}: {label}")
    described, folder = [], f"{root}/data/{label}-{uuid.uuid4().hex}"
    for name, df in tables.items():
        path = f"{folder}/{name}"
        df.write.parquet(path)
        rows, checksum = _checksum(spark.read.schema(df.schema).parquet(path))  # of what is stored
        described.append({"name": name, "path": path, "files": _listed(spark, path), "rows": rows,
                          "checksum": checksum, "columns": df.schema.json()})
    revision = 0 if last is None else last + 1
    manifest = {
        "version": label, "time": None if isinstance(version, str) else version.isoformat(), "revision": revision,
        "n_files": len(tables) if n_files is None else n_files, "tables": described,
    }
    try:
        _publish_file(spark, f"{root}/log/{label}-{revision:06}.json", json.dumps(manifest))
    except VersionTaken:
        data, system = _files(spark, folder)
        system.delete(data, True)  # nothing refers to it
        raise


def _manifest(spark: SparkSession, root: str, version: datetime | str):
    found = manifests(spark, root).filter(F.col("version") == label_of(version)).first()
    if found is None:
        raise VersionMissing(f"{root}: {label_of(version)}")
    return found


def _read(spark: SparkSession, table) -> DataFrame:
    columns = StructType.fromJson(json.loads(table.columns))
    if not table.files:
        return spark.createDataFrame([], columns)
    return spark.read.schema(columns).parquet(*[f"{table.path}/{f.name}" for f in table.files])


def load_version(spark: SparkSession, root: str, version: datetime | str) -> dict[str, DataFrame]:
    """The tables of a version, read from the files of its manifest."""
    return {t.name: _read(spark, t) for t in _manifest(spark, root, version).tables}


def verify_version(spark: SparkSession, root: str, version: datetime | str) -> None:
    """``VersionDamaged`` if a file, a row count or a checksum differs from the manifest."""
    for table in _manifest(spark, root, version).tables:
        wanted = [(f.name, f.bytes) for f in table.files]
        there = {f["name"]: f["bytes"] for f in _listed(spark, table.path)}
        if [(n, there.get(n)) for n, _ in wanted] != wanted:
            raise VersionDamaged(f"files of {table.name}")
        if _checksum(_read(spark, table)) != (table.rows, table.checksum):
            raise VersionDamaged(f"rows of {table.name}")


def list_versions(spark: SparkSession, root: str) -> DataFrame:
    """Complete versions with a time, and their number of artefacts: version, n_files."""
    return manifests(spark, root).filter("time is not null").select(
        F.to_timestamp_ntz("time").alias("version"), "n_files"
    )
