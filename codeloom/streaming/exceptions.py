"""Exception feed: codes that appear in a stream and are mapped nowhere."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from codeloom.functions.text import code_key
from codeloom.schemas import NEW_CODE_REPORT


def _batch_path(path: str, batch: int) -> str:
    return f"{path}/batch_id={batch}"


def _report(master: DataFrame, path: str, code: str, time: str, mapping: str) -> Callable[[DataFrame, int], None]:
    def write(rows: DataFrame, batch: int) -> None:
        seen = (
            rows.select(code_key(code).alias("code"), F.col(time).alias("_time"))
            .filter(F.col("code").isNotNull() & (F.col("code") != ""))
            .groupBy("code")
            .agg(F.min("_time").alias("first_seen"), F.count("*").alias("volume"))
        )
        known = master.select(code_key(mapping).alias("code"))
        # Overwriting the folder of this batch makes a replay harmless.
        seen.join(known, "code", "left_anti").write.mode("overwrite").parquet(_batch_path(path, batch))

    return write


def report_new_codes(
    stream: DataFrame, master: DataFrame, path: str, checkpoint: str, code: str, time: str, mapping: str
) -> StreamingQuery:
    """Report unknown codes with their first sighting and their volume.

    Every micro-batch is first reduced to its distinct codes (map-side, so hot codes cost nothing);
    what was seen lives in the output table, not in a state store that grows for ever.
    """
    query = (
        stream.writeStream.foreachBatch(_report(master, path, code, time, mapping))
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return query


def reported_codes(spark: SparkSession, path: str) -> DataFrame:
    """Each unknown code once: when it was first seen, and how often in all batches so far."""
    seen = spark.read.schema(NEW_CODE_REPORT).parquet(f"{path}/batch_id=*")
    return seen.groupBy("code").agg(F.min("first_seen").alias("first_seen"), F.sum("volume").alias("volume")).select(*seen.columns)
