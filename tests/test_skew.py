import random
import re

import pytest
from conftest import rows
from pyspark.sql import functions as F

from codeloom.operators.skew import SALTS, lookup_join
from codeloom.registry import all_queries


@pytest.fixture
def no_broadcasts(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def tables(spark, n=4000):
    rng = random.Random(5)
    data = [(rng.choice(["hot", "hot", "warm", None, f"k{rng.randint(0, 300)}"]), i, "x" * (i % 7)) for i in range(n)]
    facts = spark.createDataFrame(data, "k string, i int, _other string").repartition(40, "i")
    dim = spark.createDataFrame([("hot", "H", 1), ("k1", "one", 2), ("k2", None, 3), ("unused", "u", 4), (None, "never", 5)], "k string, t string, n int")
    return facts, dim


def final_plan(df):
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.split("== Initial Plan ==")[0]


@pytest.mark.parametrize("how", ["left", "inner"])
def test_salted_join_equals_a_plain_join(spark, no_broadcasts, how):
    facts, dim = tables(spark)
    got, plain = lookup_join(facts, dim, "k", how), facts.join(dim, "k", how)
    assert got.columns == plain.columns and rows(got) == rows(plain)


@pytest.mark.parametrize("how", ["left", "inner"])
def test_small_dimensions_are_left_to_the_planner(spark, how):
    facts, dim = tables(spark)
    got = lookup_join(facts, dim, "k", how)
    assert rows(got) == rows(facts.join(dim, "k", how))


def test_facts_are_read_and_moved_once(spark, no_broadcasts, tmp_path):
    facts, dim = tables(spark)
    facts.write.parquet(str(tmp_path / "facts"))
    dim.write.parquet(str(tmp_path / "dim"))
    got = lookup_join(spark.read.parquet(str(tmp_path / "facts")), spark.read.parquet(str(tmp_path / "dim")), "k")
    got.collect()
    plan = final_plan(got)
    assert len(re.findall(r"FileScan parquet \[k#\d+,i#", plan)) == 1 and "ReusedExchange" in plan


@pytest.mark.parametrize("name, reads", [("q_account_context", {"lineitem": 1, "orders": 1}), ("q_purpose_lob", {"orders": 2, "customer": 1})])
def test_queries_read_each_input_once(spark, sf, no_broadcasts, name, reads):
    """Accounts and relationships of q_purpose_lob are two inputs, both made of orders."""
    df = all_queries()[name][0](spark, sf)
    df.collect()
    plan = final_plan(df)
    assert {t: len(re.findall(rf"Location: InMemoryFileIndex.*/{t}\.parquet", plan)) for t in reads} == reads


def test_a_key_with_half_of_the_rows_spreads_over_tasks(spark, no_broadcasts):
    facts = spark.range(0, 40_000, 1, 64).select(F.when(F.col("id") % 2 == 0, "hot").otherwise(F.concat(F.lit("k"), "id")).alias("k"), "id")
    dim = spark.createDataFrame([("hot", "H")], "k string, t string")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        placed = lookup_join(facts, dim, "k").withColumn("task", F.spark_partition_id()).filter("k = 'hot'")
        sizes = [r["count"] for r in placed.groupBy("task").count().collect()]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(sizes) == 20_000 and len(sizes) > SALTS / 3 and max(sizes) <= 20_000 / 5


def test_rows_without_a_key_spread_too(spark, no_broadcasts):
    facts = spark.range(0, 8000, 1, 8).select(F.lit(None).cast("string").alias("k"), "id")
    dim = spark.createDataFrame([("hot", "H")], "k string, t string")
    placed = lookup_join(facts, dim, "k").withColumn("task", F.spark_partition_id())
    assert placed.filter("t IS NULL").count() == 8000 and lookup_join(facts, dim, "k", "inner").count() == 0


def test_other_joins_are_refused(spark):
    with pytest.raises(ValueError):
        lookup_join(spark.range(1), spark.range(1), "id", "full")
