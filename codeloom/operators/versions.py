"""Result sets kept per prompt version."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from codeloom.operators.evaluation import rate, weighted_rate


def versions(results: DataFrame) -> DataFrame:
    return results.select("prompt_version").distinct().orderBy("prompt_version")


def latest_version(results: DataFrame) -> DataFrame:
    """Version of the latest run; ties go to the larger label."""
    return results.agg(
        F.max_by("prompt_version", F.struct("run_timestamp", "prompt_version")).alias("prompt_version")
    )


def of_version(results: DataFrame, version: str | None = None) -> DataFrame:
    """Rows of one version, or of the latest: a literal or scalar filter prunes version partitions."""
    wanted = F.lit(version) if version else latest_version(results).scalar()
    return results.filter(F.col("prompt_version") == wanted)


def compare_versions(
    results: DataFrame, matched: DataFrame, flags: Sequence[str], weight: str, tracked: Sequence[str] = ("exact_match",)
) -> DataFrame:
    """One row per version: accuracies, weighted accuracies, cost, and the change since the version before.

    ``results`` holds all rows, ``matched`` the layer-1 rows with match columns. The change looks at one
    row per version, which is why its window may run over all of them.
    """
    per_batch = results.groupBy("prompt_version", "batch_id").agg(
        F.count("*").alias("codes"), F.max("estimated_cost").alias("cost")
    )
    totals = per_batch.groupBy("prompt_version").agg(
        F.sum("codes").alias("codes"), F.round(F.sum("cost"), 6).alias("estimated_cost")
    )
    metrics = [F.count("*").alias("l1_codes")]
    for flag in flags:
        metrics.append(rate(F.col(flag)).alias(flag))
        metrics.append(weighted_rate(F.col(flag), F.col(weight)).alias(f"w_{flag}"))
    scored = matched.groupBy("prompt_version").agg(*metrics)
    order = Window.orderBy("prompt_version")
    changes = {
        f"delta_w_{flag}": F.round(F.col(f"w_{flag}") - F.lag(f"w_{flag}").over(order), 6) for flag in tracked
    }
    changes["delta_cost"] = F.round(F.col("estimated_cost") - F.lag("estimated_cost").over(order), 6)
    return totals.join(scored, "prompt_version", "left").withColumns(changes)
