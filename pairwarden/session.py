"""Session settings and the shared folder that staged tables go to."""

from __future__ import annotations

import io
import threading
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = "*", app: str = "pairwarden") -> SparkSession:
    """Session for tests and benchmarks; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir`` of the session, else its warehouse."""
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return configured.rstrip("/")


def _application_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/staged-{spark.sparkContext.applicationId}"


def fresh_path(spark: SparkSession, name: str) -> str:
    """Unused path below the shared folder, grouped by application for clean-up."""
    return f"{_application_folder(spark)}/{name}-{uuid.uuid4().hex}"


_SCOPES = threading.local()  # staged paths of the scopes that are open in a thread


def stage(df: DataFrame, name: str, outlive: bool = False) -> DataFrame:
    """Write ``df`` once and read it back: later jobs neither recompute it nor
    depend on the executors that produced it. With ``outlive`` it stays after the innermost
    ``staged_scope``, as long as the next one."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    scopes = getattr(_SCOPES, "open", [])
    for scope in scopes[:-1][-1:] if outlive else scopes[-1:]:
        scope.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def staged_scope(spark: SparkSession) -> Iterator[None]:
    """Delete what is staged inside, by this thread, when it ends; frames built on it end with it."""
    own: list[str] = []
    _SCOPES.open = [*getattr(_SCOPES, "open", []), own]
    try:
        yield
    finally:
        _SCOPES.open = _SCOPES.open[:-1]
        for path in own:
            _delete(spark, path)


def _delete(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


_SHIPPED: set[str] = set()  # applications whose executors have the package


def ship_package(spark: SparkSession) -> None:
    """Give executors the package, like ``--py-files``: operators that run Python in tasks need it.

    Once per application; the package goes as a zip through the shared folder, where it stays.
    """
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    root = Path(__file__).parent
    held = io.BytesIO()
    with zipfile.ZipFile(held, "w") as out:
        for source in sorted(root.rglob("*.py")):
            out.write(source, f"{root.name}/{source.relative_to(root)}")
    # beside the staged tables: executors that start late fetch it, too
    folder = f"{shared_folder(spark)}/package-{context.applicationId}-{uuid.uuid4().hex}"
    target = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{root.name}.zip")
    stream = target.getFileSystem(context._jsc.hadoopConfiguration()).create(target)
    stream.write(bytearray(held.getvalue()))
    stream.close()
    context.addPyFile(target.toString())
    _SHIPPED.add(context.applicationId)


def drop_staged(spark: SparkSession) -> None:
    """Delete the staged tables of this application; frames built on them end with it."""
    _delete(spark, _application_folder(spark))
