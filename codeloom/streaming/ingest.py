"""Continuous ingest of extracts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from codeloom.sources.ragged import repair, repair_marked


def open_files(spark: SparkSession, path: str, schema: T.StructType, kind: str = "parquet", per_trigger: int | None = None) -> DataFrame:
    """File stream with a declared schema; files already seen are not read again."""
    reader = spark.readStream.format(kind).schema(schema)
    if per_trigger:
        reader = reader.option("maxFilesPerTrigger", per_trigger)
    return reader.load(path)


def open_ragged(
    spark: SparkSession, path: str, header: Sequence[str], per_trigger: int | None = None
) -> tuple[DataFrame, DataFrame]:
    """(rows, rejects) of a stream of ragged files: the same expressions as the batch reader."""
    reader = spark.readStream.format("text")
    if per_trigger:
        reader = reader.option("maxFilesPerTrigger", per_trigger)
    return repair(reader.load(path), header)


def drain(df: DataFrame, path: str, checkpoint: str, mode: str = "append", partition_by: Sequence[str] = ()) -> StreamingQuery:
    """Process everything available into parquet files, then stop."""
    writer = df.writeStream.format("parquet").outputMode(mode).option("path", path)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    query = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def ingest_ragged(
    spark: SparkSession, source: str, header: Sequence[str], path: str, checkpoint: str, per_trigger: int | None = None
) -> StreamingQuery:
    """Rows and rejects of a stream of ragged files from one reading, each in its own partition below ``path``.

    The counters of every micro-batch (sound, repaired, rejected) are taken in the same pass and lie in its progress as ``repair``.
    """
    reader = spark.readStream.format("text")
    if per_trigger:
        reader = reader.option("maxFilesPerTrigger", per_trigger)
    marked = repair_marked(reader.load(source), header).observe(
        "repair", F.count_if(~F.col("_repaired")).alias("sound"), F.count_if("_repaired").alias("repaired"), F.count_if("_rejected").alias("rejected")
    )
    return drain(marked, path, checkpoint, partition_by=["_rejected"])


def _marked(spark: SparkSession, path: str, header: Sequence[str]) -> DataFrame:
    cells = [T.StructField(c.strip(), T.StringType()) for c in header]
    marks = T.StructType.fromDDL("_repaired boolean, _line string, _fields int, _rejected boolean")
    return spark.read.schema(T.StructType([*cells, *marks])).parquet(path)


def ingested(spark: SparkSession, path: str, header: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(rows, rejects) that ``ingest_ragged`` wrote so far; each reads its own partition only."""
    marked = _marked(spark, path, header)
    rows = marked.filter(~F.col("_rejected")).drop("_line", "_fields", "_rejected")
    return rows, marked.filter("_rejected").select(F.col("_line").alias("line"), F.col("_fields").alias("fields"))


def ingest_counts(spark: SparkSession, path: str) -> DataFrame:
    """One row with the counters of all batches so far, as ``repair_counts`` has them for files. Reads one column."""
    return _marked(spark, path, []).agg(
        F.count_if(~F.col("_repaired")).alias("sound"), F.count_if("_repaired").alias("repaired"), F.count_if("_rejected").alias("rejected")
    )


def event_time(df: DataFrame, column: str) -> DataFrame:
    """Watermarks need a zoned timestamp; the session time zone is UTC."""
    return df.withColumn(column, F.col(column).cast("timestamp"))
