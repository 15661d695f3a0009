"""Benchmark decontamination: containment search of short test items in long documents, by MinHash and with DataFrame functions only.

Under one random hash of all shingles, the smallest shingle of an item lies in a document with a probability equal to the item's
containment in it, however long the document is. So an item is sketched by its smallest shingle under each of several hashes, and
a document is probed with all its shingles. Items are partitioned by their size, as in an LSH ensemble: each size class has its
own number of hashes and of votes, so that an item contained to the threshold is missed with less than a set probability while
chance matches of large items, which share many phrases with other texts, are not even candidates. Candidates are then verified
on the shingles themselves, as text.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from codeloom.llm.tables import Store, bounded_side, read_table, text_mark, without

WORDS = 5
CONTAINMENT_PERCENT = 75
MISS = 1e-6
# Hashes for items of up to so many shingles; larger ones use the last number. A single shingle is its own smallest.
SIZE_CLASSES = ((1, 1), (8, 10), (16, 12), (64, 16), (None, 24))


def votes_needed(hashes: int, percent: int, miss: float = MISS) -> int:
    """The most votes that an item contained to the threshold fails to get with at most the probability ``miss``; at least one."""
    p, below, votes = percent / 100, 0.0, 0
    while votes < hashes:
        below += math.comb(hashes, votes) * p ** votes * (1 - p) ** (hashes - votes)
        if below > miss:
            break
        votes += 1
    return max(1, votes)


def words_of(text: str) -> Column:
    """Runs of letters and digits, in lower case. Null has none."""
    return F.array_remove(F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), r"[^\p{L}\p{N}]+"), "")


def run_hashes(words: str, n: int) -> Column:
    """A 64-bit hash of every run of ``n`` words, in order; none in a shorter text."""
    picked = ", ".join(f"{words}[i + {j}]" for j in range(n))
    return F.expr(f"case when size({words}) >= {n} then transform(sequence(0, size({words}) - {n}), i -> xxhash64({picked})) else array() end")


def run_texts(words: str, n: int) -> Column:
    """The same runs as text."""
    return F.expr(
        f"case when size({words}) >= {n} then transform(sequence(1, size({words}) - {n - 1}), i -> concat_ws(' ', slice({words}, i, {n})))"
        " else array() end"
    )


def of_item(runs: Callable[[str, int], Column]) -> Column:
    """The distinct shingles of an item: its runs of five words, or the whole item if it has fewer; none without words."""
    found = runs("_words", WORDS)
    for n in range(1, WORDS):
        found = F.when(F.size("_words") == n, runs("_words", n)).otherwise(found)
    return F.array_distinct(found)


def of_text(runs: Callable[[str, int], Column], lengths: Sequence[int]) -> Column:
    """The distinct runs of a text, of every length that shingles of items have."""
    return F.array_distinct(F.concat(*[runs("_words", n) for n in lengths]))


def _lengths(tests: DataFrame) -> list[int]:
    """The lengths of the items' shingles in words: at most five numbers, usually the five alone."""
    found = tests.filter(F.size("_words") > 0).select(F.least(F.size("_words"), F.lit(WORDS)).alias("n")).distinct().collect()
    return sorted(row.n for row in found) or [WORDS]


def _sketches(items: DataFrame, percent: int) -> DataFrame:
    """Columns item_id, n, votes, h and hash, one row per item and hash of its size class: the item's smallest shingle h."""
    distinct = items.select("item_id", F.explode(of_item(run_hashes)).alias("h")).distinct()
    sized = distinct.join(distinct.groupBy("item_id").agg(F.count("*").alias("n")), "item_id")
    hashes, votes = F.lit(SIZE_CLASSES[-1][1]), F.lit(votes_needed(SIZE_CLASSES[-1][1], percent))
    for most, count in reversed(SIZE_CLASSES[:-1]):
        hashes = F.when(F.col("n") <= most, count).otherwise(hashes)
        votes = F.when(F.col("n") <= most, votes_needed(count, percent)).otherwise(votes)
    thrown = sized.select("item_id", "n", votes.alias("votes"), "h", F.explode(F.sequence(F.lit(1), hashes)).alias("hash"))
    return thrown.groupBy("item_id", "n", "votes", "hash").agg(F.min_by("h", F.xxhash64("h", "hash")).alias("h"))


def contaminated(docs: DataFrame, items: DataFrame, percent: int = CONTAINMENT_PERCENT) -> DataFrame:
    """Columns doc_id, item_id, n_shared, n_item, containment: the documents that hold an item, with every item they hold.

    A document holds an item if at least ``percent`` of the item's distinct shingles occur in it. Words are runs of letters and
    digits in lower case. An item of fewer than five words is one shingle and is found wherever its words stand consecutively;
    what a script without blanks writes between two punctuation marks is one word. Null, empty or wordless items and texts hold nothing and are in nothing. Rows of one doc_id count as one
    document, rows of one item_id as one item; rows without an id take no part. Other columns are ignored.
    """
    store = Store(docs.sparkSession, "benchmark")
    texts = docs.filter("doc_id is not null").select("doc_id", words_of("text").alias("_words"))
    tests = items.filter("item_id is not null").select("item_id", words_of("text").alias("_words"))

    lengths = _lengths(tests)
    sketches = store.keep(_sketches(tests, percent))
    probes = texts.select("doc_id", F.explode(of_text(run_hashes, lengths)).alias("h"))
    hits = probes.join(bounded_side(sketches), "h").select("doc_id", "item_id", "votes", "hash").distinct()
    candidates = store.keep(
        hits.groupBy("doc_id", "item_id").agg(F.count("*").alias("found"), F.max("votes").alias("votes"))
        .filter("found >= votes").select("doc_id", "item_id")
    )

    whole = store.keep(tests.select("item_id", F.explode(of_item(run_texts)).alias("shingle")).distinct())
    sizes = whole.groupBy("item_id").agg(F.count("*").alias("n_item"))
    held = texts.join(candidates.select("doc_id").distinct(), "doc_id", "left_semi")
    shared = (
        held.select("doc_id", F.explode(of_text(run_texts, lengths)).alias("shingle"))
        .join(bounded_side(whole), "shingle").select("doc_id", "item_id", "shingle").distinct()
        .groupBy("doc_id", "item_id").agg(F.count("*").alias("n_shared"))
    )
    return (
        shared.join(candidates, ["doc_id", "item_id"], "left_semi").join(sizes, "item_id")
        .filter(100 * F.col("n_shared") >= percent * F.col("n_item"))
        .select("doc_id", "item_id", "n_shared", "n_item", (F.col("n_shared") / F.col("n_item")).alias("containment"))
    )


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that hold no benchmark item.

    Every row is judged by its own text, rows without a doc_id and repeats of one too. An empty table stays empty; all columns stay.
    """
    rows = docs.select(F.struct("doc_id", text_mark().alias("mark")).alias("doc_id"), "text")
    return without(docs, contaminated(rows, read_table(spark, sf_dir, "benchmark")).select("doc_id.*"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


SQL = """
WITH i AS (SELECT item_id, list_filter(regexp_split_to_array(lower(text), '[^\\p{L}\\p{N}]+'), lambda x: x <> '') AS ws FROM benchmark),
q AS (SELECT DISTINCT item_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
  ELSE list_transform(range(1, len(ws) - 3), lambda k: array_to_string(ws[k:k + 4], ' ')) END) AS g FROM i),
n AS (SELECT item_id, count(*) AS n_item FROM q GROUP BY item_id),
m AS (SELECT DISTINCT least(len(ws), 5) AS m FROM i WHERE len(ws) > 0),
t AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '[^\\p{L}\\p{N}]+'), lambda x: x <> '') AS ws FROM documents),
d AS (SELECT DISTINCT doc_id, unnest(list_transform(range(1, len(ws) - m + 2), lambda k: array_to_string(ws[k:k + m - 1], ' '))) AS g FROM t, m),
s AS (SELECT doc_id, item_id, count(*) AS n_shared FROM d JOIN q USING (g) GROUP BY 1, 2)
SELECT doc_id, item_id, n_shared, n_item, n_shared / n_item AS containment FROM s JOIN n USING (item_id)
WHERE 100 * n_shared >= 75 * n_item
"""
