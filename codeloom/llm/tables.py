"""Tables written to the shared folder between the steps of an operator, and what all operators do alike with rows."""

from __future__ import annotations

import pickle
from typing import Any

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from codeloom.session import work_dir

# An equality join is planned as a broadcast when its small side has at most this many rows (each a few numbers wide).
BROADCAST_ROWS = 200_000


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


class Store:
    """Tables below the shared folder, so that a lost executor costs no more than the step that was running.

    ``keep`` writes a frame and returns what was written. ``drop`` removes a table that no later step reads.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.root = work_dir(spark, label)
        self.made = 0

    def keep(self, df: DataFrame) -> DataFrame:
        self.made += 1
        path = f"{self.root}/{self.made}"
        df.write.parquet(path)
        kept = self.spark.read.schema(df.schema).parquet(path)
        kept._store_path = path
        return kept

    def drop(self, *kept: DataFrame) -> None:
        for df in kept:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(df._store_path)
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def bounded_side(df: DataFrame, rows: int | None = None) -> DataFrame:
    """A small kept table, marked for broadcast only if its counted rows are within the bound; otherwise the join shuffles."""
    return F.broadcast(df) if (df.count() if rows is None else rows) <= BROADCAST_ROWS else df


class Shared:
    """A value sent to all tasks as bytes that hold its classes too, so that executors need no copy of this package."""

    def __init__(self, spark: SparkSession, value: Any):
        self.sent = spark.sparkContext.broadcast(cloudpickle.dumps(value))

    def get(self) -> Any:
        """The value, made anew; once a task is enough."""
        return pickle.loads(self.sent.value)


def text_mark() -> Column:
    """Tells rows of one doc_id apart by their texts."""
    return F.xxhash64("text")


def without(docs: DataFrame, dropped: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose doc_id and ``text_mark`` are not together in a row of ``dropped`` (columns doc_id, mark).

    Rows are judged one by one: a doc_id that occurs with several texts may keep some of them, and rows without a doc_id go like others.
    """
    gone = dropped.select(F.col("doc_id").alias("_dropped"), F.col("mark").alias("_mark")).distinct()
    return docs.join(gone, F.col("doc_id").eqNullSafe(F.col("_dropped")) & (text_mark() == F.col("_mark")), "left_anti")
