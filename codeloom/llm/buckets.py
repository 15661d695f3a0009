"""From buckets of look-alikes to classes, without listing all pairs of a bucket."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from codeloom.llm.components import components
from codeloom.llm.tables import Store, bounded_side

Verify = Callable[[DataFrame], DataFrame]
# Gives a column of one side of a pair by its name.
Side = Callable[[str], Column]
# Deals rows of buckets into buckets again: (rows, level from 1) to rows of the same columns.
Finer = Callable[[DataFrame, int], DataFrame]
# A bucket of so many indexed nodes is compared pair by pair: a row costs at most as many pairs. Larger ones that are mixed are dealt anew.
CROWD = 8


def classes_of_buckets(
    buckets: DataFrame, fits: Callable[[Column, Column], Column], verify: Verify, store: Store,
    details: DataFrame | None = None, plausible: Callable[[Side, Side], Column] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Classes of nodes that are connected through verified pairs of one bucket, and those pairs.

    ``buckets`` has columns key, node, size and indexed. Candidates are the pairs of a bucket of which at least one node is
    indexed there and ``fits(size, size)`` holds; ``verify`` takes pairs (a, b) and returns those that are true links.

    First every node meets only the smallest indexed node of its buckets: pairs grow with the rows, not with their square, and
    a group of copies however large is joined up. Then, in buckets that still hold several classes, the pairs from different
    classes that have not met are verified too. A pair is left out only if its nodes are already in one class, so the classes
    are those that all candidate pairs would give. With ``details`` (column node and others), these pairs must also be
    ``plausible``, judged by the details and the key: most look-alikes that are no links end there, before they become rows. A node without details is always plausible.

    Returns (node, component) for nodes with links, and the verified pairs (a, b).
    """
    entry = F.struct("node", "size")
    heads = store.keep(
        buckets.groupBy("key").agg(
            F.min(F.when(F.col("indexed"), entry)).alias("head"), F.min("node").alias("low"), F.max("node").alias("high"),
        ).filter("head is not null and low < high").select("key", "head")
    )
    members = store.keep(buckets.join(heads, "key"))
    first = store.keep(
        members.filter("node <> head.node").filter(fits(F.col("size"), F.col("head.size")))
        .select(F.least("node", "head.node").alias("a"), F.greatest("node", "head.node").alias("b")).distinct()
    )
    links = store.keep(verify(first))
    grouped = store.keep(components(links, store))

    placed = store.keep(
        members.drop("head").join(grouped, "node", "left").withColumn("component", F.coalesce("component", "node"))
        .groupBy("key", "node", "size", "component").agg(F.max("indexed").alias("indexed"))
    )
    mixed = store.keep(
        placed.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")).filter("low < high").select("key")
    )
    open_rows = placed.join(mixed, "key")
    meet = (F.col("l.key") == F.col("r.key")) & (F.col("l.component") != F.col("r.component")) & fits(F.col("l.size"), F.col("r.size"))
    if details is not None:
        open_rows = store.keep(open_rows.join(details, "node", "left"))
        meet &= F.coalesce(plausible(lambda name: F.col(f"l.{name}"), lambda name: F.col(f"r.{name}")), F.lit(True))
    # Two indexed nodes meet in one order only.
    meet &= ~F.col("l.indexed") | (F.col("l.node") < F.col("r.node"))
    left, right = open_rows.alias("l"), open_rows.filter("indexed").alias("r")
    apart = left.join(right, meet).select(F.least("l.node", "r.node").alias("a"), F.greatest("l.node", "r.node").alias("b")).distinct()
    second = store.keep(apart.join(first, ["a", "b"], "left_anti"))
    store.drop(heads, members, first, placed, mixed)
    if second.isEmpty():
        return grouped, links
    more = store.keep(links.unionByName(verify(second)))
    final = store.keep(components(more, store))
    store.drop(second, grouped, links)
    return final, more


def classes_of_finer_buckets(buckets: DataFrame, verify: Verify, store: Store, finer: Finer) -> DataFrame | None:
    """As ``classes_of_buckets``, but a large bucket whose members are not all links of its first one is dealt anew instead of being compared in pairs.

    ``buckets`` has columns key, node, indexed and others that ``finer`` reads. Candidates are the pairs of a bucket of which at
    least one node is indexed there. ``finer`` takes the rows of such large buckets and gives buckets in which any two nodes that
    met there and are true links meet again, and fewer others do; at some level no bucket may hold anything but links. So the work
    of a group that has a key in common and little else grows with its rows, and no link is lost.

    A level asks only which members are linked to their bucket's first node, so classes are made once, from the links of all levels.

    Returns (node, component) for nodes with links, None if there are no links.
    """
    found, level = [], 0
    while True:
        indexed = F.when(F.col("indexed"), F.col("node"))
        # Rows that are there twice count twice: a bucket then passes for crowded, which costs work and no link.
        shared = store.keep(
            buckets.groupBy("key").agg(F.min(indexed).alias("head"), F.min("node").alias("low"), F.max("node").alias("high"), F.count(indexed).alias("nodes"))
            .filter("head is not null and low < high").select("key", "head", (F.col("nodes") > CROWD).alias("crowded"))
        )
        placed = store.keep(buckets.join(bounded_side(shared), "key").distinct())
        small, large = placed.filter("not crowded"), placed.filter("crowded")
        # Two indexed nodes meet in one order only.
        meet = (F.col("l.key") == F.col("r.key")) & (F.col("l.node") != F.col("r.node")) & (~F.col("l.indexed") | (F.col("l.node") < F.col("r.node")))
        apart = small.alias("l").join(small.filter("indexed").alias("r"), meet).select(F.col("l.node").alias("node"), F.col("r.node").alias("head"))
        pairs = store.keep(
            large.filter("node <> head").select("node", "head").unionByName(apart)
            .select(F.least("node", "head").alias("a"), F.greatest("node", "head").alias("b")).distinct()
        )
        found.append(store.keep(verify(pairs)))
        sides = large.filter("node <> head").withColumns({"a": F.least("node", "head"), "b": F.greatest("node", "head")})
        mixed = sides.join(found[-1], ["a", "b"], "left_anti").select("key").distinct()
        crowd = large.join(mixed, "key", "left_semi").select(*buckets.columns)
        level += 1
        buckets = store.keep(finer(crowd, level))
        store.drop(shared, placed, pairs)
        if buckets.isEmpty():
            break
    links = reduce(DataFrame.unionByName, found)
    return None if links.isEmpty() else components(links, store)
