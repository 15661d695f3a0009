import random
import statistics

import pandas as pd
from conftest import rows
from pyspark.sql import functions as F

from codeloom.operators import batching, ordering


def test_running_total_equals_a_sequential_one(spark):
    rng = random.Random(1)
    data = [(rng.choice(["a", "a", "a", "b", None]), i, rng.randint(0, 9)) for i in range(500)]
    df = spark.createDataFrame(data, "g string, k int, w int").repartition(7)
    got = rows(ordering.running_total(df, ["g"], ["k"], F.col("w"), "upto"), "g", "k", "upto")
    totals, want = {}, []
    for g, k, w in sorted(data, key=lambda r: r[1]):
        totals[g] = totals.get(g, 0) + w
        want.append((g, k, totals[g]))
    assert got == sorted(want, key=repr)


def test_position_without_groups(spark):
    df = spark.range(1000).repartition(9)
    got = ordering.running_total(df, [], ["id"]).filter(F.col("position") != F.col("id") + 1).count()
    assert got == 0


def test_cap_and_first_per_key(spark):
    df = spark.createDataFrame([("a", 3), ("a", 1), ("b", 2), (None, 5), (None, 4)], "k string, o int")
    assert rows(ordering.first_per_key(df, ["k"], ["o"])) == rows(spark.createDataFrame([("a", 1), ("b", 2), (None, 4)], "k string, o int"))
    assert ordering.cap_per_key(df, ["k"], ["o"], 2).count() == 5


def test_describe_equals_pandas(spark):
    rng = random.Random(2)
    values = [round(rng.random(), 2) for _ in range(301)] + [0.95] * 200
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v double")
    got = ordering.describe_numeric(df, "v").first().asDict()
    want = pd.Series(values).describe()
    for ours, theirs in (("count", "count"), ("mean", "mean"), ("std", "std"), ("min", "min"), ("p25", "25%"), ("p50", "50%"), ("p75", "75%"), ("max", "max")):
        assert abs(got[ours] - want[theirs]) < 1e-9, ours
    assert got["p50"] == statistics.median(values)


def test_batches_have_fixed_size_and_follow_the_data(spark):
    data = [("Deposit", f"d{i:03d}") for i in range(65)] + [("Loan", f"l{i:03d}") for i in range(25)]
    df = spark.createDataFrame(data, "source_file string, code string")
    got = batching.assign_batches(df.repartition(5), "source_file", ["code"], batching.PRODUCT_BATCH)
    sizes = {r["batch_id"]: r["count"] for r in got.groupBy("batch_id").count().collect()}
    assert sizes == {"Deposit-0": 30, "Deposit-1": 30, "Deposit-2": 5, "Loan-0": 10, "Loan-1": 10, "Loan-2": 5}
    again = batching.assign_batches(df.repartition(2), "source_file", ["code"], batching.PRODUCT_BATCH)
    assert rows(got) == rows(again)
    first = got.filter("batch_id = 'Loan-1'").orderBy("position").collect()
    assert [r["code"] for r in first] == [f"l{i:03d}" for i in range(10, 20)]
