"""Difficulty layers: one truth path, several, or none."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from codeloom.functions.levels import layer_name


def path_counts(truth: DataFrame, code: str, levels: Sequence[str]) -> DataFrame:
    """Distinct level paths per code. The struct keeps paths that hold nulls, which
    ``count_distinct(a, b, ...)`` would skip."""
    return truth.groupBy(code).agg(F.count_distinct(F.struct(*levels)).alias("n_mappings"))


def layer_of(n_mappings: Column) -> Column:
    return F.when(n_mappings.isNull(), 3).when(n_mappings > 1, 2).otherwise(1)


def assign_layers(catalog: DataFrame, truth: DataFrame, code: str, levels: Sequence[str]) -> DataFrame:
    counted = path_counts(truth, code, levels)
    return (
        catalog.join(counted, code, "left").withColumn("layer", layer_of(F.col("n_mappings"))).drop("n_mappings")
    )


def layer_summary(catalog: DataFrame, code: str, weight: str) -> DataFrame:
    """Distinct codes, total weight and its share per layer. The overall total is taken over the three
    layer rows, so the catalog is read once."""
    overall = F.sum("total").over(Window.partitionBy())
    return (
        catalog.groupBy("layer")
        .agg(F.count_distinct(code).alias("codes"), F.sum(weight).alias("total"))
        .select(
            "layer",
            layer_name("layer").alias("name"),
            "codes",
            "total",
            F.bround(F.col("total") / overall * 100, 1).alias("pct"),
        )
    )


def layer_listing(catalog: DataFrame, code: str, weight: str) -> DataFrame:
    """Codes of every layer, heaviest first."""
    return catalog.orderBy("layer", F.desc(weight), code)


def truth_coverage(catalog: DataFrame, truth: DataFrame, code: str) -> DataFrame:
    """Mapped and unmapped raw codes, and the mapped share."""
    known = truth.select(code).distinct().withColumn("_known", F.lit(True))
    raw = catalog.select(code).distinct().join(known, code, "left")
    mapped = F.count_if(F.col("_known"))
    return raw.agg(
        mapped.alias("mapped"),
        F.count_if(F.col("_known").isNull()).alias("unmapped"),
        F.round(mapped / F.count("*"), 6).alias("share"),
    )
