"""Tables and files the pipelines read and write."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from codeloom.functions.text import nullify

# Tokens stored as null on insert.
INSERT_NULLS = ("nan", "None", "NaT", "")


def load(spark: SparkSession, name: str) -> DataFrame:
    """A catalog table, or a parquet path when the name looks like one."""
    return spark.read.parquet(name) if "/" in name else spark.table(name)


def load_version(spark: SparkSession, name: str, version: str) -> DataFrame:
    """Rows of one prompt version; only its partition is read."""
    return load(spark, name).filter(F.col("prompt_version") == version)


def save(df: DataFrame, name: str, partition_by: Sequence[str] = (), replace_schema: bool = False) -> None:
    """Overwrite a table or a parquet path; with partitions, only those present in the frame."""
    writer = df.write.mode("overwrite")
    if replace_schema:
        writer = writer.option("overwriteSchema", "true")
    if partition_by:
        writer = writer.option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by)
    if "/" in name:
        writer.parquet(name)
    else:
        writer.saveAsTable(name)


def save_results(df: DataFrame, path: str) -> None:
    """Result sets keep their versions: a run replaces its own version and leaves the others."""
    save(df, path, ["prompt_version"])


def save_bucketed(df: DataFrame, name: str, key: str, buckets: int, path: str | None = None) -> None:
    """Overwrite a table that is dealt into ``buckets`` by the hash of ``key``, one file each, sorted by it.

    Joins on the key of tables with equal numbers of buckets, and groupings by it, need no exchange; so the rows are moved once, when
    written. Meant for tables with few rows per key, as results and truths have: all rows of a key are in one bucket. ``path``
    keeps the files outside the warehouse.
    """
    writer = df.repartition(buckets, key).write.mode("overwrite").bucketBy(buckets, key).sortBy(key)
    (writer.option("path", path) if path else writer).saveAsTable(name)


def export_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def null_tokens(df: DataFrame) -> DataFrame:
    """Textual null tokens become real nulls before an insert."""
    kinds = dict(df.dtypes)
    return df.select(
        *[nullify(F.col(c), INSERT_NULLS).alias(c) if kinds[c] == "string" else F.col(c) for c in df.columns]
    )


def append(df: DataFrame, table: str) -> None:
    null_tokens(df).write.insertInto(table)


def create_schema(spark: SparkSession, name: str) -> None:
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name}")


def create_table(spark: SparkSession, table: str, schema: T.StructType) -> None:
    """Drop and create an empty typed table."""
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    spark.catalog.createTable(table, source="parquet", schema=schema)


def empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)
