"""Sheets whose level headers apply to the rows below them."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from codeloom.functions.text import strip


def first_filled(cells: Sequence[str]) -> Column:
    """First non-blank cell of a row."""
    return F.coalesce(*[F.when(strip(c) != "", strip(c)) for c in cells])


def before_sentinel(df: DataFrame, sheet: str, rn: str, is_sentinel: Column) -> DataFrame:
    """Rows above the first sentinel row of their sheet; all rows when there is none."""
    stops = df.groupBy(sheet).agg(F.min(F.when(is_sentinel, F.col(rn))).alias("_stop"))
    kept = df.join(stops, sheet)
    return kept.filter(F.col("_stop").isNull() | (F.col(rn) < F.col("_stop"))).drop("_stop")


def fill_levels(
    df: DataFrame, sheet: str, rn: str, levels: Sequence[str], start: Column | None = None, chunk_rows: int = 100_000
) -> DataFrame:
    """Give every row the level path in force at it.

    A header at level k sets k and clears the deeper levels. A level is therefore live while no
    shallower header came after the row that set it (a header on the same row does not clear it).
    With ``start``, only rows below the first row of a sheet that satisfies it are kept and looked at;
    a sheet without such a row is an error.

    A single window per sheet would run a whole sheet in one task, so rows are cut into chunks of
    consecutive row numbers: each chunk fills itself, and the last header of each level in the
    chunks before it is carried in through a frame with one row per chunk.
    """
    marked = df.withColumn("_chunk", F.floor(F.col(rn) / chunk_rows).cast("bigint"))
    for i, level in enumerate(levels):
        value = F.when(strip(level) != "", F.col(level))
        marked = marked.withColumn(f"_h{i}", F.when(value.isNotNull(), F.struct(F.col(rn).alias("r"), value.alias("v"))))
    heads = [f"_h{i}" for i in range(len(levels))]
    marked = marked.withColumn("_mark", F.lit(None).cast("bigint") if start is None else F.when(start, F.col(rn)))

    # max over (row number, value) is the latest header: row numbers are unique within a sheet.
    ends = marked.groupBy(sheet, "_chunk").agg(*[F.max(h).alias(h) for h in heads], F.min("_mark").alias("_mark"))
    before = Window.partitionBy(sheet).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    first = F.min("_mark").over(Window.partitionBy(sheet))
    if start is not None:
        message = F.concat(F.lit("no hierarchy heading in "), F.col(sheet).cast("string"))
        first = F.when(first.isNotNull(), first).otherwise(F.raise_error(message).cast("bigint"))
    carried = ends.select(
        sheet, "_chunk", first.alias("_start"), *[F.max(h).over(before).alias(f"_c{i}") for i, h in enumerate(heads)]
    )

    inside = Window.partitionBy(sheet, "_chunk").orderBy(rn).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = marked.withColumns({f"_l{i}": F.max(h).over(inside) for i, h in enumerate(heads)})
    joined = local.join(carried, [sheet, "_chunk"])
    if start is not None:
        joined = joined.filter(F.col(rn) > F.col("_start"))
    latest = []
    for i in range(len(levels)):
        found = F.coalesce(F.col(f"_l{i}"), F.col(f"_c{i}"))
        # Cells above the start are no headers; the latest header is above it only if none came below.
        latest.append(found if start is None else F.when(found["r"] > F.col("_start"), found))
    path = {}
    for i, level in enumerate(levels):
        set_at = latest[i]["r"]
        shallower = [F.coalesce(latest[j]["r"] <= set_at, F.lit(True)) for j in range(i)]
        live = reduce(lambda a, b: a & b, shallower, set_at.isNotNull())
        path[level] = F.when(live, latest[i]["v"])
    kept = [c for c in df.columns if c not in levels]
    return joined.select(*kept, *[path[level].alias(level) for level in levels])
