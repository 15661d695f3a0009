"""Taxonomy documents as numbered lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_document(spark: SparkSession, path: str) -> DataFrame:
    """Lines with their file and order."""
    return spark.read.text(path).select(
        F.col("_metadata.file_path").alias("sheet"), F.monotonically_increasing_id().alias("rn"), "value"
    )
