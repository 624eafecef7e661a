"""Prepares a session: small Arrow batches, and the package for executors that do not have it."""

from __future__ import annotations

import io
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

import pairwarden
from pairwarden.session import fresh_path


ARROW_BATCH = "4m"


def prepare(spark: SparkSession) -> None:
    """Arrow batches of a few megabytes, since Python workers hold some of them at a time and keep
    the memory; once per application the package as a zip in the shared folder, like ``--py-files``."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", ARROW_BATCH)
    context = spark.sparkContext
    if any("pairwarden" in f and f.endswith(".zip") for f in context._python_includes):
        return
    root = Path(pairwarden.__file__).parent
    held = io.BytesIO()
    with zipfile.ZipFile(held, "w") as out:
        for source in sorted(root.rglob("*.py")):
            out.write(source, f"pairwarden/{source.relative_to(root)}")
    target = spark._jvm.org.apache.hadoop.fs.Path(f"{fresh_path(spark, 'package')}/pairwarden.zip")
    stream = target.getFileSystem(context._jsc.hadoopConfiguration()).create(target)
    stream.write(bytearray(held.getvalue()))
    stream.close()
    context.addPyFile(target.toString())
