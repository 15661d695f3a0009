"""Catalogs kept up by daily deltas: signed counts per (code, kind, text), merged when read.

A catalog needs no rows, only how often each text stands next to each code. A delta adds the counts of its rows and takes those of
retracted rows away, so its cost follows the delta; volumes, most frequent texts and shares come from the sums. What a delta did is
kept in a folder of its own, which a replay overwrites; ``compact`` sums them up.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from codeloom.functions.text import strip
from codeloom.operators.frequency import BLANK_TEXTS, json_member, sample_text
from codeloom.session import children, remove

# The kind whose counts are those of the rows themselves.
ROWS = ""
TALLY = "code string, kind string, text string, n bigint"


def signed_tally(rows: DataFrame, code: Column, kinds: Mapping[str, Column], sign: Column | None = None) -> DataFrame:
    """(code, kind, text, n) out of rows, read once and combined before they move. ``sign``: 1 for rows that came, -1 for rows that went.

    Rows without a code do not count. A null text counts for its row, not for its kind.
    """
    if ROWS in kinds:
        raise ValueError("the empty kind stands for the rows themselves")
    pairs = [F.struct(F.lit(kind).alias("kind"), text.cast("string").alias("text")) for kind, text in kinds.items()]
    whole = F.struct(F.lit(ROWS).alias("kind"), F.lit(None).cast("string").alias("text"))
    sign = F.lit(1) if sign is None else sign
    laid = rows.select(code.alias("code"), sign.cast("long").alias("sign"), F.inline(F.array(whole, *pairs)))
    counted = laid.filter(F.col("code").isNotNull() & ((F.col("kind") == ROWS) | F.col("text").isNotNull()))
    return counted.groupBy("code", "kind", "text").agg(F.sum("sign").alias("n")).filter("n <> 0")


def _numbers(spark: SparkSession, path: str, name: str) -> list[int]:
    return sorted(int(m[1]) for m in (re.fullmatch(rf"{name}=(\d+)", c) for c in children(spark, path)) if m)


def write_delta(tally: DataFrame, path: str, number: int) -> None:
    """Keep the tally of delta ``number``; writing it again replaces it. A delta that went into a compaction must not come back."""
    if any(number <= upto for upto in _numbers(tally.sparkSession, path, "upto")):
        return
    tally.write.mode("overwrite").parquet(f"{path}/delta={number}")


def merged(spark: SparkSession, path: str) -> DataFrame:
    """All deltas summed up. A count that has come down to zero is gone; see ``overdrawn`` for those below."""
    upto = _numbers(spark, path, "upto")[-1:]
    folders = [f"{path}/upto={n}" for n in upto] + [f"{path}/delta={n}" for n in _numbers(spark, path, "delta") if not upto or n > upto[0]]
    if not folders:
        return spark.createDataFrame([], TALLY)
    parts = [spark.read.schema(TALLY).parquet(f) for f in folders]
    return reduce(DataFrame.unionByName, parts).groupBy("code", "kind", "text").agg(F.sum("n").alias("n")).filter("n <> 0")


def compact(spark: SparkSession, path: str) -> DataFrame:
    """Sum all deltas up in one folder, named by the last of them, and retire what went into it."""
    before, deltas = _numbers(spark, path, "upto"), _numbers(spark, path, "delta")
    if not before and not deltas:
        return merged(spark, path)
    upto = max(before + deltas)
    if upto not in before:
        merged(spark, path).write.mode("overwrite").parquet(f"{path}/upto={upto}")
    for n in deltas:
        remove(spark, f"{path}/delta={n}")
    for n in before:
        if n != upto:
            remove(spark, f"{path}/upto={n}")
    return merged(spark, path)


def overdrawn(tallies: DataFrame) -> DataFrame:
    """Counts below zero: rows were retracted that had never come."""
    return tallies.filter("n < 0")


def tally_stream(
    changes: DataFrame, path: str, checkpoint: str, code: Column, kinds: Mapping[str, Column], sign: Column
) -> StreamingQuery:
    """One delta for each micro-batch of a stream of changes."""
    def write(rows: DataFrame, batch: int) -> None:
        write_delta(signed_tally(rows, code, kinds, sign), path, batch)

    query = changes.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def feed_kinds(text: str, distributions: Mapping[str, Column] | None = None) -> dict[str, Column]:
    """The kinds of a feed: its descriptions and any values whose distribution the catalog shows."""
    return {"description": strip(F.col(text).cast("string")), **(distributions or {})}


def catalog(
    tallies: DataFrame, keep: int = 5, shown: Mapping[str, Callable[[Column], Column]] | None = None, digits: int = 3
) -> DataFrame:
    """Volume and most frequent descriptions per code, and one JSON distribution for each further kind in ``shown``.

    The value of ``shown`` turns a text into what equally frequent ones are ordered by. One shared exchange by (code, kind) serves all
    kinds: only ``keep`` texts of each are ever collected. A code without rows left is left out.
    """
    shown = shown or {}
    text, kind = F.col("text"), F.col("kind")
    # Blank descriptions are counted in the volume and ranked last; a kind's share is one of all its counts.
    blank = (kind == "description") & text.isin(*BLANK_TEXTS)
    total = F.sum("n").over(Window.partitionBy("code", "kind"))
    by_value = reduce(lambda out, item: F.when(kind == item[0], item[1](text).cast("double")).otherwise(out), shown.items(), F.lit(None).cast("double"))
    order = Window.partitionBy("code", "kind").orderBy(F.asc(F.coalesce(blank, F.lit(False))), F.desc("n"), F.asc(by_value), F.asc("text"))
    placed = tallies.withColumn("rn", F.row_number().over(order)).withColumn("total", total).filter(F.col("rn") <= keep)
    member = json_member(text, F.bround(F.col("n") / F.col("total"), digits))
    samples = F.collect_list(F.when((kind == "description") & ~blank, F.struct("rn", "text", "n")))
    whole = placed.groupBy("code").agg(
        F.max(F.when(kind == ROWS, F.col("n"))).alias("volume"), samples.alias("samples"),
        *[F.array_sort(F.collect_list(F.when(kind == k, F.struct("rn", member.alias("m"))))).alias(f"kind_{i}") for i, k in enumerate(shown)],
    )
    def listed(i: int) -> Column:
        members = F.array_join(F.transform(f"kind_{i}", lambda e: e["m"]), ", ")
        return F.when(F.size(f"kind_{i}") > 0, F.concat(F.lit("{"), members, F.lit("}")))

    return whole.filter(F.col("volume") > 0).select(
        F.col("code"), "volume", sample_text(F.col("samples"), "text").alias("description_samples"), *[listed(i).alias(k) for i, k in enumerate(shown)],
    )
