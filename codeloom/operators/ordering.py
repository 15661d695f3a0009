"""Numbering, running totals and exact quantiles without gathering a group in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from codeloom.session import settle

QUARTILES = {"p25": 0.25, "p50": 0.5, "p75": 0.75}


def running_total(
    df: DataFrame, by: Sequence[str], order: Sequence[str], weight: Column | None = None, out: str = "position"
) -> DataFrame:
    """Inclusive running total of ``weight`` (1 by default) per ``by`` group in ``order``.

    A window over the group would sort a whole group in one task. Here rows are range-partitioned on
    (group, order), so a large group spreads over many slices; each slice is totalled on its own and
    shifted by the totals of the slices before it. The slice number is settled first: both branches
    must see the same slices. (``by``, ``order``) must be unique.
    """
    weight = F.lit(1) if weight is None else weight
    # One struct column stands for the group: structs holding nulls compare as equal.
    group = F.struct(*[F.col(c) for c in by]) if by else F.lit(0)
    placed = settle(
        df.repartitionByRange(*[F.col(c) for c in (*by, *order)])
        .withColumn("_slice", F.spark_partition_id())
        .withColumn("_group", group)
    )
    totals = placed.groupBy("_slice", "_group").agg(F.sum(weight).alias("_total"))
    # One row per slice and group, so this window stays small however large a group is.
    earlier = Window.partitionBy("_group").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    shifts = totals.select("_slice", "_group", F.coalesce(F.sum("_total").over(earlier), F.lit(0)).alias("_shift"))
    inside = (
        Window.partitionBy("_slice", "_group")
        .orderBy(*[F.col(c) for c in order])
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    local = placed.withColumn("_local", F.sum(weight).over(inside))
    joined = local.join(shifts, ["_slice", "_group"])
    return joined.select(*df.columns, (F.col("_local") + F.col("_shift")).alias(out))


def first_per_key(df: DataFrame, key: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """Keep the first row of each key; the rank limit is applied before the shuffle as well as after it."""
    return cap_per_key(df, key, order, 1)


def cap_per_key(df: DataFrame, key: Sequence[str], order: Sequence[Column | str], limit: int) -> DataFrame:
    """Keep the first ``limit`` rows of each key. ``order`` must be total to be repeatable."""
    window = Window.partitionBy(*key).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).filter(F.col("_rank") <= limit).drop("_rank")


def top_k(df: DataFrame, order: Sequence[Column | str], k: int) -> DataFrame:
    return df.orderBy(*order).limit(k)


def describe_numeric(df: DataFrame, column: str) -> DataFrame:
    """count, mean, std, min, quartiles and max as one row, with exact interpolated quartiles.

    Nulls and NaN are no values. Values are first reduced to (value, occurrences); a distributed running total then locates the
    ranks around each quartile, so no task holds all distinct values.
    """
    values = df.select(F.col(column).cast("double").alias("v")).filter(F.col("v").isNotNull() & ~F.isnan("v"))
    tally = values.groupBy("v").agg(F.count("*").alias("n"))
    placed = running_total(tally, [], ["v"], F.col("n"), "upto").withColumn("start", F.col("upto") - F.col("n"))
    # One scalar subquery gives size and mean to every row.
    moments = placed.agg(
        F.struct(F.sum("n").alias("count"), (F.sum(F.col("v") * F.col("n")) / F.sum("n")).alias("mean"))
    ).scalar()
    placed = placed.withColumn("_all", moments)
    count, deviation = F.col("_all.count"), F.col("v") - F.col("_all.mean")
    ends = {}
    for name, share in QUARTILES.items():
        at = (count - 1) * F.lit(share)
        for end, rank in (("lo", F.floor(at)), ("hi", F.ceil(at))):
            covers = (F.col("start") <= rank) & (rank < F.col("upto"))
            ends[f"{name}_{end}"] = F.max(F.when(covers, F.col("v")))
    found = placed.agg(
        F.sum("n").alias("count"),
        (F.sum(F.col("v") * F.col("n")) / F.sum("n")).alias("mean"),
        F.sqrt(F.sum(deviation * deviation * F.col("n")) / F.nullif(F.sum("n") - 1, F.lit(0))).alias("std"),
        F.min("v").alias("min"),
        F.max("v").alias("max"),
        *[expr.alias(name) for name, expr in ends.items()],
    )

    def between(name: str, share: float) -> Column:
        at = (F.col("count") - 1) * F.lit(share)
        return F.col(f"{name}_lo") + (F.col(f"{name}_hi") - F.col(f"{name}_lo")) * (at - F.floor(at))

    return found.select(
        "count", "mean", "std", "min", *[between(n, p).alias(n) for n, p in QUARTILES.items()], "max"
    )
