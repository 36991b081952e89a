"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "peakweave", master: str | None = None, **conf) -> SparkSession:
    """A session with the settings the operators are tuned for; `conf` keys use `__` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        "spark.ui.enabled": "false",
        # no call-site capture per column expression: it costs several driver round trips each
        "spark.python.sql.dataFrameDebugging.enabled": "false",
    }
    settings.update({k.replace("__", "."): str(v) for k, v in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return ship_package(builder.getOrCreate())


def ship_package(spark: SparkSession) -> SparkSession:
    """Send this package to the Python workers of the session, once: their functions import it by name."""
    context = spark.sparkContext
    if not getattr(context, "_peakweave_shipped", False):
        package = os.path.dirname(os.path.abspath(__file__))
        archive = shutil.make_archive(os.path.join(tempfile.mkdtemp(prefix="peakweave-"), "peakweave"), "zip",
                                      os.path.dirname(package), os.path.basename(package))
        context.addPyFile(archive)
        context._peakweave_shipped = True
    return spark


def prepare(spark: SparkSession) -> SparkSession:
    """What a session that was built elsewhere needs: the package on its workers and, on one machine, a shared folder."""
    context = spark.sparkContext
    if context.master.startswith("local[") and not (spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()):
        context.setCheckpointDir(tempfile.mkdtemp(prefix="peakweave-"))
    return ship_package(spark)


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors see, as the cluster names it in spark.checkpoint.dir."""
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not configured:
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    return configured


def materialize(df: DataFrame) -> DataFrame:
    """Write `df` once to reliable storage; partitions and row order stay fixed afterwards."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    return df.checkpoint()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path in the shared folder."""
    return os.path.join(shared_dir(spark), f"{label}-{uuid.uuid4().hex}")


def store(df: DataFrame, label: str) -> DataFrame:
    """`df` as a Parquet table in the shared folder: computed once, read by column as often as needed."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
