"""Taxonomies kept as rows of (node, parent, label): paths of any depth, and what is wrong with the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codeloom.operators.skew import lookup_join
from codeloom.operators.taxonomy import path_key
from codeloom.session import settle

# Faults of a node: no parent of that name, different parents or labels, no end of the walk upwards.
ORPHAN, AMBIGUOUS, CYCLE = "orphan", "ambiguous", "cycle"


def closure(rows: DataFrame, node: str = "node", parent: str = "parent", label: str = "label") -> DataFrame:
    """Columns node, path, depth, fault: one row per distinct node.

    ``path`` holds the labels from the topmost node down, ``depth`` counts the steps. A root has a null parent. Walking upwards from
    a node ends at a root (``fault`` is null), at a node whose parent is missing or that is stated in different ways (the path
    starts there, and all nodes below share its fault), or never (on or below a cycle: path and depth are null). Equal rows count
    once, rows with a null node not at all; a null label is a null in the path. An empty table has no nodes.

    Every round each node takes over what its pointer knows, path and next pointer, so walks double: the rounds grow with the
    logarithm of the depth, and a parent of very many nodes is dealt to many tasks. A round that finishes no node leaves cycles
    only, because the nodes above an unfinished one have all smaller depths.
    """
    stated = rows.filter(F.col(node).isNotNull()).select(
        F.col(node).alias("node"), F.col(parent).alias("parent"), F.col(label).alias("label")
    ).distinct()
    once = F.col("_ways") == 1
    state = settle(
        stated.groupBy("node").agg(F.count("*").alias("_ways"), F.min("parent").alias("parent"), F.min("label").alias("label"))
        .select("node", F.when(once, F.col("parent")).alias("up"), F.array("label").alias("path"), F.when(~once, AMBIGUOUS).alias("fault"))
    )
    left, before = state.filter("up is not null").count(), -1
    while left and left != before:
        known = state.select(
            F.col("node").alias("up"), F.col("up").alias("_up"), F.col("path").alias("_path"), F.col("fault").alias("_fault"),
            F.lit(True).alias("_there"),
        )
        met = lookup_join(state, known, "up")
        there = F.coalesce("_there", F.lit(False))
        state = settle(met.select(
            "node", F.when(there, F.col("_up")).alias("up"), F.when(there, F.concat("_path", "path")).otherwise(F.col("path")).alias("path"),
            F.when(there, F.col("_fault")).when(F.col("up").isNotNull(), ORPHAN).otherwise(F.col("fault")).alias("fault"),
        ))
        left, before = state.filter("up is not null").count(), left
    ended = F.col("up").isNull()
    return state.select(
        "node", F.when(ended, F.col("path")).alias("path"), F.when(ended, F.size("path") - 1).alias("depth"),
        F.when(ended, F.col("fault")).otherwise(CYCLE).alias("fault"),
    )


def off_tree(pred: DataFrame, levels: Sequence[str], paths: DataFrame, fewest: int = 1) -> DataFrame:
    """Predictions whose levels are no sound path of ``closure``'s rows with at least ``fewest`` levels.

    Levels are compared in canonical form; a prediction stops at a node by leaving the deeper levels null.
    """
    sound = paths.filter(F.col("fault").isNull() & F.size("path").between(fewest, len(levels)))
    legal = sound.select(path_key([F.get("path", F.lit(i)) for i in range(len(levels))]).alias("_path")).distinct()
    return pred.withColumn("_path", path_key(levels)).join(legal, "_path", "left_anti").drop("_path")
