"""Connected components of a graph too large for one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codeloom.llm.tables import Store


def _stars(edges: DataFrame) -> bool:
    """Whether every u has one v and no v is a u: each v is then the smallest of all that it is connected with."""
    ends = edges.select("u", F.lit(True).alias("leaf")).unionByName(edges.select(F.col("v").alias("u"), F.lit(False).alias("leaf")))
    wrong = ends.groupBy("u").agg(F.count_if("leaf").alias("n"), F.count_if(~F.col("leaf")).alias("m")).filter("n > 1 or n = 1 and m > 0")
    return wrong.agg(F.count("*")).first()[0] == 0


def components(links: DataFrame, store: Store) -> DataFrame:
    """Columns (node, component) for the nodes of ``links`` (columns a, b): component is the smallest node that can be reached.

    Large-star and small-star in turn: every node hangs its larger neighbours, then its smaller ones, on the smallest it knows.
    A round at least halves long chains; the rounds end when only stars are left. The smallest neighbours are written before they
    are joined back, so both sides of the join are plain shuffles, and a node with very many links is split over tasks. Links of a
    node to itself change nothing.
    """
    edges = store.keep(
        links.filter("a is not null and b is not null and a <> b")
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    )
    while not _stars(edges):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = store.keep(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")))
        larger = store.keep(both.filter("v > u").join(lowest, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        own = store.keep(larger.groupBy("u").agg(F.min("v").alias("m")))
        hung = larger.join(own, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        fresh = store.keep(hung.unionByName(own.select("u", F.col("m").alias("v"))).distinct())
        store.drop(edges, lowest, larger, own)
        edges = fresh
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
