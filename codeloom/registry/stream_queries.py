"""Streaming jobs over the event table, each run to its end and read back."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from codeloom.registry import views as v
from codeloom.session import work_dir
from codeloom.streaming import current, exceptions, ingest, volumes

Query = tuple[Callable[[SparkSession, str], DataFrame], str | None]
QUERIES: dict[str, Query] = {}


def query(name: str, sql: str | None = None):
    def register(build):
        QUERIES[name] = (build, sql)
        return build

    return register


# Micro-batches that the events arrive in.
SLICES = 4
HEADER = ["A", "B", "C", "D", "E", "F", "DESC1", "DESC2", "END"]


def _events(spark: SparkSession, sf: str) -> DataFrame:
    """The events as a stream of files, one per trigger, in the order of their times."""
    # Event times carry no zone; day windows are UTC days.
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    events, folder = v.table(spark, sf, "events"), work_dir(spark, "events")
    low, high = events.agg(F.min("ts"), F.max("ts")).first()
    bounds = [low + (high - low) * n / SLICES for n in range(1, SLICES)] if low else []
    for n in range(len(bounds) + 1):
        part = events.filter(F.col("ts") >= F.lit(bounds[n - 1])) if n else events
        # Events without a time come first.
        part = part.filter(F.coalesce(F.col("ts") < F.lit(bounds[n]), F.lit(n == 0))) if n < len(bounds) else part
        part.coalesce(1).write.parquet(f"{folder}/{n}")
    return ingest.event_time(ingest.open_files(spark, f"{folder}/*/*.parquet", events.schema, per_trigger=1), "ts")


def _ingested_turns(spark: SparkSession, sf: str) -> str:
    """Every turn as a ragged line of its whole text, every third also as a line too short, in several files that a stream picks up."""
    source, out = work_dir(spark, "lines"), work_dir(spark, "rows")
    flat = F.translate("text", "\n\r\"", "  ")
    conversations = v.table(spark, sf, "conversations")
    sound = F.concat_ws(",", F.col("conv_id").cast("string"), F.col("turn").cast("string"), "role", F.lit("d"), F.lit("e"), F.lit("f"), flat, F.lit("x"), F.lit("end"))
    short = F.when(F.col("turn") % 3 == 0, F.concat_ws(",", F.col("conv_id").cast("string"), F.lit("short")))
    # By turn as well: no conversation is one task's.
    conversations.repartition(SLICES, "conv_id", "turn").select(F.explode(F.array_compact(F.array(sound, short)))).write.text(source)
    ingest.ingest_ragged(spark, source, HEADER, out, work_dir(spark, "state"), per_trigger=1)
    return out


@query("q_stream_ingest", """
SELECT CAST(conv_id AS VARCHAR) AS conv, count(*) AS n, count(*) FILTER (turn % 3 = 0) AS rejected FROM conversations GROUP BY 1""")
def q_stream_ingest(spark: SparkSession, sf: str) -> DataFrame:
    """Ragged lines of whole texts in several files, then picked up by a stream; every third turn also sends a line too short."""
    rows, rejects = ingest.ingested(spark, _ingested_turns(spark, sf), HEADER)
    good = rows.select(F.col("A").alias("conv"), F.lit(0).alias("bad"))
    wrong = rejects.select(F.substring_index("line", ",", 1).alias("conv"), F.lit(1).alias("bad"))
    return good.unionByName(wrong).groupBy("conv").agg(F.count_if(F.col("bad") == 0).alias("n"), F.count_if(F.col("bad") == 1).alias("rejected"))


@query("q_stream_repair_counts", """
SELECT count(*) FILTER (commas = 0) AS sound, count(*) FILTER (commas > 0) AS repaired, count(*) FILTER (turn % 3 = 0) AS rejected
FROM (SELECT turn, length(translate(text, chr(10) || chr(13) || '"', '  ')) - length(replace(translate(text, chr(10) || chr(13) || '"', '  '), ',', '')) AS commas
      FROM conversations)""")
def q_stream_repair_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Lines taken as they are, repaired and rejected, of a stream that is read once."""
    return ingest.ingest_counts(spark, _ingested_turns(spark, sf))


@query("q_stream_upsert", """
SELECT user_id, event_id, event_type, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""")
def q_stream_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """Changes in several batches, merged into a snapshot that retires them."""
    out, target = work_dir(spark, "current"), work_dir(spark, "snapshot")
    key, order = ["user_id"], ["ts", "event_id"]
    current.upsert_stream(_events(spark, sf), out, work_dir(spark, "state"), key, order)
    current.compact(spark, out, target, key, order)
    return current.current_records(spark, out, key, order, target=target).select("user_id", "event_id", "event_type", "value")


@query("q_stream_dedupe", "SELECT event_id, event_type, value FROM events")
def q_stream_dedupe(spark: SparkSession, sf: str) -> DataFrame:
    """Every row arrives twice and leaves once."""
    out = work_dir(spark, "unique")
    doubled = _events(spark, sf).withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2))))
    unique = volumes.without_replays(doubled, ["event_id"], "ts", "40 days").drop("copy")
    ingest.drain(unique, out, work_dir(spark, "state"))
    return spark.read.schema(unique.schema).parquet(out).select("event_id", "event_type", "value")


@query("q_stream_windows", """
SELECT strftime(date_trunc('day', ts), '%Y-%m-%d') AS window_start, event_type, count(*) AS volume FROM events GROUP BY date_trunc('day', ts), event_type
HAVING date_trunc('day', any_value(ts)) + INTERVAL 1 DAY <= (SELECT max(ts) FROM events) - INTERVAL 1 DAY""")
def q_stream_windows(spark: SparkSession, sf: str) -> DataFrame:
    """Closed day windows; windows the watermark still holds open are not emitted."""
    out = work_dir(spark, "windows")
    counted = volumes.window_volume(_events(spark, sf), "event_type", "ts", "1 day")
    ingest.drain(counted, out, work_dir(spark, "state"))
    return spark.read.schema(counted.schema).parquet(out).select(
        F.date_format("window_start", "yyyy-MM-dd").alias("window_start"), "event_type", "volume"
    )


@query("q_stream_new_codes", """
SELECT upper(event_type) AS code, strftime(min(ts), '%Y-%m-%d %H:%M:%S.%f') AS first_seen, count(*) AS volume FROM events
WHERE upper(event_type) NOT IN (SELECT upper(role) FROM conversations) AND event_type NOT IN ('click', 'view') GROUP BY 1""")
def q_stream_new_codes(spark: SparkSession, sf: str) -> DataFrame:
    """Event types that neither the roles nor the mapped types know."""
    out = work_dir(spark, "exceptions")
    known = v.table(spark, sf, "conversations").select(F.col("role").alias("code")).distinct().unionByName(
        v.table(spark, sf, "events").filter(F.col("event_type").isin("click", "view")).select(F.col("event_type").alias("code")).distinct()
    )
    exceptions.report_new_codes(_events(spark, sf), known, out, work_dir(spark, "state"), "event_type", "ts", "code")
    stamp = F.date_format("first_seen", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    return exceptions.reported_codes(spark, out).withColumn("first_seen", stamp)
