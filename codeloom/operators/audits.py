"""Data-quality audits. Each gives rows (audit, column, failing_rows, passed)."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

# Accepted states of the suggestion table.
PRODUCT_STATES = ("ACTIVE", "INACTIVE", "DISCONTINUED")
REVIEW_STATES = (
    "PENDING_REVIEW", "REQUIRES_MANUAL_MAPPING", "NEEDS_MANUAL_REVIEW", "APPROVED", "REJECTED",
)


def not_null(columns: Sequence[str]) -> list[tuple[str, str, Column]]:
    return [("not_null", c, F.col(c).isNull()) for c in columns]


def accepted_values(column: str, allowed: Iterable[str]) -> tuple[str, str, Column]:
    """Nulls pass: presence is another audit."""
    return ("accepted_values", column, ~F.col(column).isin(*allowed))


def accepted_range(column: str, low: float, high: float) -> tuple[str, str, Column]:
    return ("accepted_range", column, (F.col(column) < low) | (F.col(column) > high))


def marked(column: str, marker: str = "ERROR") -> tuple[str, str, Column]:
    return ("error_rows", column, F.col(column) == marker)


def row_audits(df: DataFrame, checks: Sequence[tuple[str, str, Column]]) -> DataFrame:
    """All row-wise checks in one scan."""
    counts = df.agg(*[F.count_if(F.coalesce(bad, F.lit(False))).alias(f"c{i}") for i, (_, _, bad) in enumerate(checks)])
    entries = F.array(
        *[
            F.struct(F.lit(a).alias("audit"), F.lit(c).alias("column"), F.col(f"c{i}").alias("failing_rows"))
            for i, (a, c, _) in enumerate(checks)
        ]
    )
    return _verdict(counts.select(F.inline(entries)))


def unique_combination(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Number of key combinations that occur more than once."""
    repeated = df.groupBy(*columns).agg(F.count("*").alias("n"))
    counted = repeated.agg(F.count_if(F.col("n") > 1).alias("failing_rows"))
    return _verdict(
        counted.select(F.lit("unique_combination").alias("audit"), F.lit(",".join(columns)).alias("column"), "failing_rows")
    )


def row_count(df: DataFrame, name: str, minimum: int = 1) -> DataFrame:
    counted = df.agg(F.count("*").alias("n"))
    return _verdict(
        counted.select(
            F.lit("row_count").alias("audit"), F.lit(name).alias("column"),
            F.when(F.col("n") < minimum, F.lit(minimum) - F.col("n")).otherwise(F.lit(0)).cast("bigint").alias("failing_rows"),
        )
    )


def _verdict(df: DataFrame) -> DataFrame:
    return df.select("audit", "column", "failing_rows", (F.col("failing_rows") == 0).alias("passed"))


def all_audits(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def suggestion_audits(suggestions: DataFrame) -> DataFrame:
    """The audits declared for the suggestion table."""
    checks = [
        *not_null(["PROD_product_type_id", "PROD_core_system_mapping", "PROD_status", "review_status"]),
        accepted_values("PROD_status", PRODUCT_STATES),
        accepted_values("review_status", REVIEW_STATES),
        accepted_range("confidence", 0, 1),
    ]
    return all_audits([row_audits(suggestions, checks), unique_combination(suggestions, ["PROD_product_type_id"])])


def require_columns(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Schema check without a job."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    return df


def observed(df: DataFrame, name: str, **metrics: Column) -> tuple[DataFrame, Observation]:
    """Counters taken while the frame is computed anyway (rows before a filter, rows repaired)."""
    watch = Observation(name)
    return df.observe(watch, *[expr.alias(label) for label, expr in metrics.items()]), watch
