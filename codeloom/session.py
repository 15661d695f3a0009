"""Session settings and the shared folder used to cut lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(app: str = "codeloom", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """Folder for checkpoints and intermediate tables, as named in ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder: on a cluster that folder
    would live on one machine and vanish with it.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="codeloom-")
        spark.conf.set("spark.checkpoint.dir", root)
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(root)
    return root.rstrip("/")


def _application_root(spark: SparkSession) -> str:
    return f"{shared_root(spark)}/codeloom/{spark.sparkContext.applicationId}"


def work_dir(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder, in a folder of this application."""
    return f"{_application_root(spark)}/{label}-{uuid.uuid4().hex}"


def children(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies in a folder of any file system Spark knows; none if there is no such folder."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    return sorted(s.getPath().getName() for s in files.listStatus(folder)) if files.exists(folder) else []


def remove(spark: SparkSession, path: str) -> None:
    """Delete a file or folder with what is in it."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def release(spark: SparkSession) -> None:
    """Delete all intermediate tables of this application. Frames that were built on them cannot be read any more."""
    remove(spark, _application_root(spark))


def settle(df: DataFrame) -> DataFrame:
    """Write the frame to the shared folder and read it back.

    Used where several branches must see the very same rows (slice numbers, hot keys, answers of a
    non-deterministic backend) even when an executor is lost in between. A columnar table rather
    than a checkpoint: later steps read only the columns they need, and joins know its size.
    """
    path = work_dir(df.sparkSession, "settled")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
