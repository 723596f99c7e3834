"""Session settings and the shared working folder."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Bodies are large: small Arrow batches keep Python workers' memory low, whatever
    # the length of a body.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "4096",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(2 << 20),
}


def ship_package(spark: SparkSession) -> None:
    """Give the executors' Python workers this package, once per application."""
    context = spark.sparkContext
    if getattr(context, "tidegate_shipped", False):
        return
    package = os.path.dirname(os.path.abspath(__file__))
    folder = tempfile.mkdtemp(prefix="tidegate-package-")
    archive = shutil.make_archive(
        os.path.join(folder, "tidegate"), "zip", os.path.dirname(package), "tidegate"
    )
    context.addPyFile(archive)
    context.tidegate_shipped = True


def configure(spark: SparkSession) -> SparkSession:
    """Apply the run-time settings the operators rely on to an existing session."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    ship_package(spark)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    Only a local session may fall back to a temporary folder of this machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    fallback = tempfile.mkdtemp(prefix="tidegate-")
    spark.conf.set("spark.checkpoint.dir", fallback)
    return fallback


def run_dir(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder path of the shared folder for one run."""
    return os.path.join(shared_dir(spark), f"{name}-{uuid.uuid4().hex}")


def materialize(spark: SparkSession, df, name: str, **options):
    """Write a frame to the shared folder and read it back: cuts lineage and
    survives the loss of executors. ``options`` go to the Parquet writer."""
    path = run_dir(spark, name)
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
