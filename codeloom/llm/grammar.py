"""Re-Pair over a table of short-alphabet strings: the most frequent pairs of neighbouring symbols become symbols of their own.

Pairs are counted by Spark over all strings; only the most frequent ones reach the driver. Any set of rules rebuilds the same
strings, so the bounds below decide how short the strings get, never what they mean.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_RULES = 256
MAX_ROUNDS = 12
# A pair this much rarer than the first rule's shortens the strings too little for a rule of its own.
LEAST_SHARE = 0.02
# Pairs looked at in a round; those that share no symbol with a more frequent one become rules.
PAIRS_READ = 32
# Rules are written as characters of the private use area.
FIRST_RULE = 0xE000


def rule_symbol(n: int) -> str:
    return chr(FIRST_RULE + n)


def compressed(text: Column, rules: list[str], first: int = 0) -> Column:
    """Every pair that is a rule replaced by the rule's symbol, from the left, rule by rule in their order."""
    return reduce(lambda out, n: F.replace(out, F.lit(rules[n]), F.lit(rule_symbol(n))), range(first, len(rules)), text)


def repair_rules(strings: DataFrame, text: str, weight: str, max_rules: int = MAX_RULES, max_rounds: int = MAX_ROUNDS) -> list[str]:
    """The pairs that became rules, in order; rule n is written as ``rule_symbol(n)``.

    ``strings`` are read once a round (keep them small: distinct strings with the number of their rows as weight).
    """
    rules: list[str] = []
    least = 2
    for _ in range(max_rounds):
        current = strings.select(compressed(F.col(text), rules).alias("s"), F.col(weight).alias("w")).filter(F.length("s") > 1)
        starts = F.sequence(F.lit(1), F.length("s") - 1)
        pairs = current.select(F.explode(F.transform(starts, lambda i: F.substr("s", i, F.lit(2)))).alias("pair"), "w")
        common = pairs.groupBy("pair").agg(F.sum("w").alias("n")).orderBy(F.desc("n"), "pair").limit(PAIRS_READ)
        taken: set[str] = set()
        for row in common.collect():
            least = max(least, LEAST_SHARE * row["n"])
            if row["n"] >= least and len(rules) < max_rules and not taken & set(row["pair"]):
                rules.append(row["pair"])
                taken |= set(row["pair"])
        if not taken:
            break
    return rules
