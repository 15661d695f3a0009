"""URL filters: the longest rule that fits a page's address decides between allow and block."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from codeloom.llm.tables import Shared, read_table

ALLOW, BLOCK = "allow", "block"
# Addresses that no rule fits.
DEFAULT = ALLOW
# The trie is sent to every task, so it has a bound; more rules are joined instead.
TRIE_RULES = 200_000

# Host, path and verdict of the registered query's rules.
RULES = (
    ("com", "/", ALLOW), ("example.com", "/en/", BLOCK), ("www.example.com", "/en/", ALLOW),
    ("net", "/es/", BLOCK), ("net", "/fr/", BLOCK),
)


def host_of(url: str) -> Column:
    """Between the first ``://`` and the next slash, question mark or hash, A-Z in lower case; empty if there is no ``://``."""
    host = F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: str) -> Column:
    """What follows the host up to a question mark or hash."""
    return F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


@dataclass
class Node:
    """A place in the trie: first the labels of a host from the last to the first, then the segments of a path."""

    labels: dict[str, Node] = field(default_factory=dict)
    segments: dict[str, Node] = field(default_factory=dict)
    # Rules that end here: the beginning of the next path segment that they ask for, rule and verdict.
    ends: list[tuple[str, str, str]] = field(default_factory=list)


def build_trie(rules: Sequence[tuple[str, str, str]]) -> Node:
    root = Node()
    for host, path, verdict in rules:
        at = root
        for label in reversed(host.split(".") if host else []):
            at = at.labels.setdefault(label, Node())
        *whole, start = path.split("/")
        for segment in whole:
            at = at.segments.setdefault(segment, Node())
        at.ends.append((start, host + path, verdict))
    return root


def longest_match(root: Node, host: str, path: str) -> tuple[str | None, str | None]:
    """Rule and verdict of the longest rule that fits; of equally long ones the block rule, then the smaller text."""
    found: list[tuple[int, bool, str, str]] = []
    segments = path.split("/")
    at, labels = root, iter(reversed(host.split(".") if host else []))
    while at is not None:
        below: Node | None = at
        for segment in segments:
            found += [(len(rule), verdict == BLOCK, rule, verdict) for start, rule, verdict in below.ends if segment.startswith(start)]
            below = below.segments.get(segment)
            if below is None:
                break
        at = at.labels.get(next(labels, None))
    if not found:
        return None, None
    size, block, _, _ = max(found)
    rule = min(r for n, b, r, _ in found if (n, b) == (size, block))
    return rule, BLOCK if block else ALLOW


def judge_urls(pages: DataFrame, rules: Sequence[tuple[str, str, str]] | DataFrame, url: str = "url", default: str = DEFAULT) -> DataFrame:
    """The columns of ``pages`` with host, path, rule and verdict; columns of these names are replaced.

    A rule (host, path, verdict) fits its host and all subdomains, if the address's path starts with its path. Of all that fit,
    the longest decides, whether it allows or blocks; of equally long ones the block rule. Without a fitting rule, rule is null
    and the verdict is ``default``. A null url, or one without ``://``, has an empty host and path, so that only rules without
    host and path could fit it. Every row is judged on its own. Rules without a host, path or verdict are empty there or left out.

    Up to TRIE_RULES rules are held as a trie by every task; more are joined on every prefix that a rule could be.
    """
    spark = pages.sparkSession
    if not isinstance(rules, DataFrame):
        rules = spark.createDataFrame(list(rules), "host string, path string, verdict string")
    rules = rules.select(
        F.coalesce("host", F.lit("")).alias("host"), F.coalesce("path", F.lit("")).alias("path"), "verdict",
    ).filter(F.col("verdict").isin(ALLOW, BLOCK)).distinct()
    pages = pages.drop("host", "path", "rule", "verdict").withColumns({"host": host_of(url), "path": path_of(url)})
    few = rules.limit(TRIE_RULES + 1).collect()
    judged = _by_trie(pages, few) if len(few) <= TRIE_RULES else _by_join(pages, rules)
    return judged.withColumn("verdict", F.coalesce("verdict", F.lit(default)))


def _by_trie(pages: DataFrame, rules: list) -> DataFrame:
    trie = Shared(pages.sparkSession, build_trie([tuple(r) for r in rules]))

    @F.pandas_udf(T.StructType([T.StructField("rule", T.StringType()), T.StructField("verdict", T.StringType())]))
    def match(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        root = trie.get()
        for hosts, paths in batches:
            yield pd.DataFrame([longest_match(root, h, p) for h, p in zip(hosts, paths)], columns=["rule", "verdict"])

    return pages.withColumn("_match", match("host", "path")).select(*pages.columns, "_match.rule", "_match.verdict")


def _by_join(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """Addresses are reduced to distinct (host, path), each lists the rules that could fit it, and those that exist are joined."""
    labels = F.split("host", r"\.")
    hosts = F.expr("concat(array(''), transform(sequence(1, size(_labels)), i -> array_join(slice(_labels, i, size(_labels)), '.')))")
    addresses = pages.select("host", "path").distinct()
    keyed = (
        addresses.withColumn("_labels", labels).withColumn("_host", F.explode(F.array_distinct(hosts)))
        .withColumn("_path", F.explode(F.expr("transform(sequence(0, length(path)), i -> substring(path, 1, i))")))
    )
    known = rules.select(
        F.col("host").alias("_host"), F.col("path").alias("_path"),
        F.struct(
            (-F.length("host") - F.length("path")).alias("size"), (F.col("verdict") != BLOCK).alias("mild"),
            F.concat("host", "path").alias("rule"), "verdict",
        ).alias("_found"),
    )
    best = keyed.join(known, ["_host", "_path"]).groupBy("host", "path").agg(F.min("_found").alias("_found"))
    return pages.join(best, ["host", "path"], "left").select(*pages.columns, "_found.rule", "_found.verdict")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = judge_urls(read_table(spark, sf_dir, "pages").select("page_id", "url"), RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict")


SQL = """
WITH p AS (
  SELECT page_id,
    translate(regexp_extract(coalesce(url, ''), '^(?s:.*?)://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(url, ''), '^(?s:.*?)://[^/?#]*([^?#]*)', 1) AS path
  FROM pages),
r(rhost, rpath, verdict) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
  ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
m AS (
  SELECT page_id, first(rhost || rpath ORDER BY length(rhost || rpath) DESC) AS rule,
    first(verdict ORDER BY length(rhost || rpath) DESC) AS verdict
  FROM p JOIN r ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath) GROUP BY page_id)
SELECT p.page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM p LEFT JOIN m ON p.page_id = m.page_id
"""
