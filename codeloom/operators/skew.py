"""Lookup joins that survive keys holding a large share of all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Parts that the rows of one key are dealt to at most.
SALTS = 32


def fits_broadcast(df: DataFrame) -> bool:
    """Whether the planner's own upper estimate of the frame is within its limit for broadcasts. Starts no job."""
    session = df.sparkSession._jsparkSession.sessionState().conf()
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()) <= session.autoBroadcastJoinThreshold()


def lookup_join(
    facts: DataFrame, dimension: DataFrame, key: str, how: str = "left", salts: int = SALTS,
    value: Column | None = None, columns: Sequence[str] | None = None,
) -> DataFrame:
    """Join rows to a dimension that has one row per ``key``; null keys match nothing.

    ``value``: what facts are looked up by, if it is not their column ``key``. ``columns``: the columns of facts that are carried along
    (all by default). A dimension within the planner's broadcast limit is left to it. Beyond, rows are dealt by (key, part), where the
    part is the number of the task that read them: a key that holds half of all rows spreads over ``salts`` tasks, while a key whose
    rows were read together stays together. The (key, part) pairs that occur are the sketch that says which dimension rows are
    needed and how often; it is taken from the very exchange that the join reads, so facts are read and moved once, provided that
    the columns carried are used afterwards (an inner join's filter reaches only one branch and costs a second reading). Rows with a
    null key stay with those of their task.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"unsupported join: {how}")
    carried = list(facts.columns if columns is None else columns)
    at = F.col(key) if value is None else value
    rows = facts if how == "left" else facts.filter(at.isNotNull())
    out = carried + [c for c in dimension.columns if c not in (key, *carried)]
    side = dimension.withColumnRenamed(key, "_found")
    if fits_broadcast(dimension):
        return rows.select(*carried, at.alias("_value")).join(side, F.col("_value") == F.col("_found"), how).select(*out)
    task = F.spark_partition_id()
    # A struct is never null itself, so no branch is filtered on it below the shared exchange.
    part = F.when(at.isNull(), task).otherwise(F.coalesce(task % salts, F.lit(0)))
    dealt = rows.select(*carried, F.struct(at.alias("value")).alias("_at"), part.alias("_part")).repartition("_at", "_part")
    # The hash refers to all columns: without it this branch would have an exchange of its own, with fewer columns.
    pairs = dealt.groupBy(F.col("_at").alias("_key"), F.col("_part").alias("_of")).agg(F.max(F.hash(*dealt.columns)).alias("_seen"))
    wanted = pairs.filter(F.col("_seen").isNotNull()).select("_key", "_of")
    if how == "inner":
        side = side.withColumn("_hit", F.lit(True))
    copies = wanted.join(side, F.col("_key")["value"] == F.col("_found"), "left").drop("_found")
    joined = dealt.join(copies, (F.col("_at") == F.col("_key")) & (F.col("_part") == F.col("_of")), "left")
    if how == "inner":
        joined = joined.filter("_hit")
    return joined.select(*out)
