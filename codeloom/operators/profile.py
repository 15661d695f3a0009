"""Column profiles of an unknown extract and their mapping to canonical columns."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from codeloom.functions.text import strip

# Rows looked at, samples kept, and the type labels.
PROFILE_ROWS = 20
PROFILE_SAMPLES = 5
DECIMALS, SMALL, INTEGERS, TEXT, DATES, EMPTY = (
    "decimal numbers", "small integers", "integers", "text", "dates (YYYY-MM-DD)", "empty",
)
# Canonical columns, names by which clients know them, and the type that supports the guess.
CANONICAL = {
    "transaction_code": (r"^(trancd|tran_?code|txn_?code|transaction_code)$|code$", (SMALL, INTEGERS)),
    "description_1": (r"^(efhds1|desc_?1|description_1)$|desc.*1$", (TEXT,)),
    "transaction_desc": (r"^(description|txn_?desc|transaction_desc|tran_?desc)$", (TEXT, EMPTY)),
}


def profile_columns(df: DataFrame, order: str, rows: int | None = None, samples: int = PROFILE_SAMPLES) -> DataFrame:
    """Type label and first samples of every column. The label judges all filled cells; with ``rows``, the extract is judged by its
    first rows alone (PROFILE_ROWS is what a quick look takes), and the label by the samples shown."""
    names = [c for c in df.columns if c != order]
    head = df if rows is None else df.orderBy(order).limit(rows)
    cells = head.select(
        F.col(order).alias("_rn"),
        F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("string").alias("value")) for c in names])),
    ).withColumn("value", strip("value"))
    filled = F.col("value").isNotNull() & (F.col("value") != "")
    window = Window.partitionBy("column").orderBy((~filled).cast("int"), "_rn")
    first = cells.withColumn("_n", F.row_number().over(window)).filter(F.col("_n") <= samples)
    shown = F.transform(F.array_sort(F.collect_list(F.when(filled, F.struct("_n", "value")))), lambda s: s["value"])
    kinds = (cells if rows is None else first).groupBy("column").agg(_kind(filled).alias("kind"))
    return kinds.join(first.groupBy("column").agg(F.array_join(shown, " | ").alias("samples")), "column")


def _kind(filled: Column) -> Column:
    """Type label of the filled cells of a column."""
    bare = F.regexp_replace(F.col("value"), "[.-]", "")
    numeric = F.bool_and(F.when(filled, bare.rlike("^[0-9]+$")))
    dotted = F.bool_or(F.when(filled, F.contains(F.col("value"), F.lit("."))))
    short = F.bool_and(F.when(filled, F.length("value") <= 3))
    dated = F.bool_or(F.when(filled, F.contains(F.col("value"), F.lit("-")) & (F.length("value") == 10)))
    return (
        F.when(F.count_if(filled) == 0, F.lit(EMPTY))
        .when(dated, F.lit(DATES))
        .when(numeric & dotted, F.lit(DECIMALS))
        .when(numeric & short, F.lit(SMALL))
        .when(numeric, F.lit(INTEGERS))
        .otherwise(F.lit(TEXT))
    )


def map_columns(profiles: DataFrame, canonical: Mapping[str, tuple[str, tuple[str, ...]]] = CANONICAL) -> DataFrame:
    """Client column for each canonical column: name counts more than type, each side is used once.

    The frame has one row per client column, so ranking all candidates is small work.
    """
    candidates = F.array(
        *[
            F.struct(
                F.lit(target).alias("canonical_column"),
                F.lit(place).alias("_place"),
                (
                    F.lower("column").rlike(pattern).cast("int") * 2
                    + F.col("kind").isin(*kinds).cast("int")
                ).alias("score"),
            )
            for place, (target, (pattern, kinds)) in enumerate(canonical.items())
        ]
    )
    scored = profiles.select("column", F.inline(candidates)).filter(F.col("score") >= 2)
    per_client = Window.partitionBy("column").orderBy(F.desc("score"), "_place")
    per_target = Window.partitionBy("canonical_column").orderBy(F.desc("score"), "column")
    best = scored.withColumn("_c", F.row_number().over(per_client)).filter(F.col("_c") == 1)
    unique = best.withColumn("_t", F.row_number().over(per_target)).filter(F.col("_t") == 1)
    return unique.select(F.col("column").alias("client_column"), "canonical_column", "score")


def mapping_table(mapping: DataFrame, run_timestamp: Column) -> DataFrame:
    """The mapping as it is stored."""
    return mapping.select("client_column", "canonical_column", run_timestamp.alias("run_timestamp"))


def as_names(mapping: DataFrame) -> dict[str, str]:
    """The mapping for renaming: column names, at most one per canonical column."""
    return {r["client_column"]: r["canonical_column"] for r in mapping.collect()}


def twice_used(mapping: DataFrame) -> DataFrame:
    """Audit: canonical columns claimed more than once."""
    return mapping.groupBy("canonical_column").count().filter(F.col("count") > 1)
