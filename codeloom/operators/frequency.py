"""Counts per code, most frequent values, value distributions and status rules."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from codeloom.functions.text import NO_DESCRIPTION, strip, thousands

# Account status to product status.
STATUS_TO_PRODUCT = {"ACTIVE": "ACTIVE", "CLOSED": "INACTIVE", "DORMANT": "INACTIVE"}
BLANK_TEXTS = ("", "nan", "None")


def code_volume(df: DataFrame, code: str, out: str = "volume") -> DataFrame:
    return df.groupBy(code).agg(F.count("*").alias(out))


def value_counts(df: DataFrame, column: str, keep_null: bool = False, out: str = "count") -> DataFrame:
    source = df if keep_null else df.filter(F.col(column).isNotNull())
    return source.groupBy(column).agg(F.count("*").alias(out)).orderBy(F.desc(out), F.asc(column))


def distinct_codes(df: DataFrame, code: str, approximate: bool = False) -> DataFrame:
    counter = F.approx_count_distinct if approximate else F.count_distinct
    return df.agg(counter(F.col(code)).alias("codes"))


def sorted_distinct(df: DataFrame, column: str) -> DataFrame:
    """Distinct non-null values in order, as rows: a collected list could outgrow one task."""
    return df.select(column).filter(F.col(column).isNotNull()).distinct().orderBy(column)


def tally(df: DataFrame, code: str, text: str, count: Column | None = None) -> DataFrame:
    """(code, text) counts; the map-side combine absorbs codes that hold most of the rows."""
    total = F.count("*") if count is None else F.sum(count)
    return df.groupBy(code, text).agg(total.alias("n"))


def ranked(tallied: DataFrame, code: str, text: str, keep: int, blank: Column | None = None) -> DataFrame:
    """The ``keep`` most frequent texts per code; ties go to the smaller text.

    ``blank`` marks texts that do not count. They are ranked last and dropped afterwards: filtering
    them first would push the filter below the tally, which could then no longer be shared.
    """
    order = [F.desc("n"), F.asc(text)]
    if blank is not None:
        order = [F.asc(F.coalesce(blank, F.lit(True))), *order]
    window = Window.partitionBy(code).orderBy(*order)
    top = tallied.withColumn("rn", F.row_number().over(window)).filter(F.col("rn") <= keep)
    return top if blank is None else top.filter(~F.coalesce(blank, F.lit(True)))


def sample_text(samples: Column, text: str) -> Column:
    """``text (1,234) | text (56)`` out of an array of (rn, text, n); empty gives the placeholder."""
    parts = F.transform(
        F.array_sort(samples), lambda s: F.concat(s[text], F.lit(" ("), thousands(s["n"]), F.lit(")"))
    )
    return F.when(F.size(samples) > 0, F.array_join(parts, " | ")).otherwise(F.lit(NO_DESCRIPTION))


def top_descriptions(
    df: DataFrame, code: str, text: str, keep: int = 5, blanks: Sequence[str] = BLANK_TEXTS
) -> DataFrame:
    """One row per non-null code: volume and its most frequent descriptions.

    One aggregation to (code, text) counts feeds both results; only ``keep`` rows per code are ever
    collected into a list.
    """
    cleaned = df.filter(F.col(code).isNotNull()).select(code, strip(F.col(text).cast("string")).alias("_text"))
    counts = tally(cleaned, code, "_text")
    volumes = counts.groupBy(code).agg(F.sum("n").alias("volume"))
    samples = (
        ranked(counts, code, "_text", keep, F.col("_text").isin(*blanks))
        .groupBy(code)
        .agg(F.collect_list(F.struct("rn", "_text", "n")).alias("_samples"))
    )
    listed = F.coalesce(F.col("_samples"), F.array().cast("array<struct<rn:int,_text:string,n:bigint>>"))
    return volumes.join(samples, code, "left").select(
        code, "volume", sample_text(listed, "_text").alias("description_samples")
    )


def distribution(
    df: DataFrame, code: str, value: str, keep: int = 5, digits: int = 3, count: Column | None = None
) -> DataFrame:
    """Top ``keep`` values per code with their share of *all* valid rows of the code, half-even rounded.

    ``count`` weighs rows that were counted already, so that a join can come after the counting.
    """
    counts = tally(df.filter(F.col(value).isNotNull()), code, value, count)
    totals = counts.groupBy(code).agg(F.sum("n").alias("_total"))
    share = F.bround(F.col("n") / F.col("_total"), digits)
    return ranked(counts, code, value, keep).join(totals, code).select(code, value, "rn", "n", share.alias("share"))


def json_member(key: Column, share: Column) -> Column:
    """``"key": share``; a one-element array gives the key its JSON quoting."""
    quoted = F.regexp_replace(F.to_json(F.array(key)), r"^\[|\]$", "")
    return F.concat(quoted, F.lit(": "), share.cast("string"))


def distributions_json(
    df: DataFrame, code: str, values: dict[str, Column], first: Column, order: Sequence[str], keep: int = 5, digits: int = 3
) -> DataFrame:
    """Row count, first non-null ``first`` value and one JSON distribution per entry of ``values``, per code.

    Every row is laid out as one (kind, value) pair per distribution plus one for the row itself, so a
    single aggregation to (code, kind, value) counts serves all results and the rows are read once.
    A distribution lists its most frequent values first; without a valid value it is null. Shares
    divide by all valid rows and round half-even. Numeric values rank by number among equals.
    """
    none = F.lit(None).cast("string")
    sample = F.when(first.isNotNull(), F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(order)], first.alias("first")))
    pairs = [
        F.struct(F.lit(k).alias("kind"), value.cast("string").alias("value"), value.try_cast("double").alias("number"))
        for k, value in values.items()
    ]
    whole = F.struct(F.lit("").alias("kind"), none.alias("value"), F.lit(None).cast("double").alias("number"))
    laid = df.select(code, sample.alias("_sample"), F.inline(F.array(*pairs, whole)))
    laid = laid.filter(F.col("value").isNotNull() | (F.col("kind") == ""))
    counts = laid.groupBy(code, "kind", "value", "number").agg(F.count("*").alias("n"), F.min("_sample").alias("_sample"))
    totals = counts.groupBy(code, "kind").agg(F.sum("n").alias("_total"), F.min("_sample").alias("_sample"))
    # The sample decides nothing here; asking for it keeps both branches on one shared exchange.
    window = Window.partitionBy(code, "kind").orderBy(F.desc("n"), F.asc("number"), F.asc("value"), F.asc("_sample"))
    top = counts.select(code, "kind", "value", "n", F.row_number().over(window).alias("rn")).filter(F.col("rn") <= keep)
    member = json_member(F.col("value"), F.bround(F.col("n") / F.col("_total"), digits))
    per_kind = (
        top.join(totals, [code, "kind"])
        .groupBy(code, "kind")
        .agg(
            F.max("_total").alias("_total"), F.min("_sample.first").alias("_first"),
            F.array_sort(F.collect_list(F.struct("rn", member.alias("m")))).alias("_members"),
        )
        .withColumn("_json", F.concat(F.lit("{"), F.array_join(F.transform("_members", lambda e: e["m"]), ", "), F.lit("}")))
    )
    return per_kind.groupBy(code).agg(
        F.max(F.when(F.col("kind") == "", F.col("_total"))).alias("rows"),
        F.max(F.when(F.col("kind") == "", F.col("_first"))).alias("first"),
        *[F.max(F.when(F.col("kind") == k, F.col("_json"))).alias(k) for k in values],
    )


def first_sample(value: str, order: Sequence[Column | str]) -> Column:
    """First non-null value in ``order``; an aggregate that does not depend on the shuffle."""
    keys = [F.col(c) if isinstance(c, str) else c for c in order]
    rank = F.when(F.col(value).isNotNull(), F.struct(*[k.alias(f"o{i}") for i, k in enumerate(keys)]))
    return F.min_by(F.col(value), rank)


def status_any_active(status: Column) -> Column:
    """ACTIVE as soon as one row is, otherwise INACTIVE; unknown states count as not active."""
    seen = F.bool_or(F.coalesce(status == "ACTIVE", F.lit(False)))
    return F.when(seen, F.lit("ACTIVE")).otherwise(F.lit("INACTIVE"))


def status_most_common(status: Column) -> Column:
    """ACTIVE as soon as one row is; ACTIVE when every state is unknown; else the most common mapped state."""
    mapped = F.lit(None).cast("string")
    for raw, product in STATUS_TO_PRODUCT.items():
        mapped = F.when(status == raw, F.lit(product)).otherwise(mapped)
    return (
        F.when(F.bool_or(F.coalesce(status == "ACTIVE", F.lit(False))), F.lit("ACTIVE"))
        .when(F.count(mapped) == 0, F.lit("ACTIVE"))
        .otherwise(F.mode(mapped, deterministic=True))
    )
