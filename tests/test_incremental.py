import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from codeloom.operators.frequency import top_descriptions
from codeloom.plans import catalogs, incremental

SCHEMA = "code string, text string, mode string, sign int"


def random_changes(seed, n=600):
    """Rows that come, some of which go again later, in four deltas."""
    rng = random.Random(seed)
    deltas = [[] for _ in range(4)]
    for i in range(n):
        row = (rng.choice(["hot", "hot", "a", "b", f"k{i % 20}", None]), rng.choice(["x", " x", "y", "", "nan", None, f"t{i % 9}"]), rng.choice(["A", "B", "B", None]))
        day = rng.randrange(4)
        deltas[day].append((*row, 1))
        if rng.random() < 0.4:
            deltas[rng.randrange(day, 4)].append((*row, -1))
    # One code comes and goes as a whole.
    deltas[0] += [("gone", "bye", "A", 1)] * 3
    deltas[3] += [("gone", "bye", "A", -1)] * 3
    return deltas


def left(deltas):
    out = []
    for delta in deltas:
        for row in delta:
            if row[3] == 1:
                out.append(row[:3])
            else:
                out.remove(row[:3])
    return out


def tallied(df):
    return incremental.signed_tally(df, F.col("code"), incremental.feed_kinds("text", {"modes": F.col("mode")}), F.col("sign"))


SHOWN = {"modes": lambda c: F.lit(None)}


@pytest.mark.parametrize("seed", range(2))
def test_deltas_equal_the_full_catalog(spark, tmp_path, seed):
    deltas, path = random_changes(seed), str(tmp_path / "tally")
    for n, delta in enumerate(deltas):
        incremental.write_delta(tallied(spark.createDataFrame(delta, SCHEMA)), path, n)
        if n == 1:
            incremental.compact(spark, path)
            # A delta that was merged is not merged a second time.
            incremental.write_delta(tallied(spark.createDataFrame(delta, SCHEMA)), path, n)
        if n == 2:
            incremental.write_delta(tallied(spark.createDataFrame(delta, SCHEMA)), path, n)
    full = spark.createDataFrame(left(deltas), "code string, text string, mode string")
    got = incremental.catalog(incremental.merged(spark, path), 5, SHOWN)
    assert rows(got.drop("modes")) == rows(top_descriptions(full, "code", "text"))
    for r in got.filter("modes IS NOT NULL").collect():
        modes = [m for c, _, m in left(deltas) if c == r["code"] and m]
        top = sorted({m: modes.count(m) for m in modes}.items(), key=lambda x: (-x[1], x[0]))
        assert [p.split(":")[0] for p in r["modes"][1:-1].split(", ")] == [f'"{m}"' for m, _ in top]
    assert incremental.overdrawn(incremental.merged(spark, path)).count() == 0
    before = rows(got)
    incremental.compact(spark, path)
    assert rows(incremental.catalog(incremental.merged(spark, path), 5, SHOWN)) == before


def test_a_stream_of_changes(spark, tmp_path):
    deltas = random_changes(5, 200)
    for n, delta in enumerate(deltas):
        spark.createDataFrame(delta, SCHEMA).coalesce(1).write.parquet(str(tmp_path / "in" / f"{n}"))
    changes = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in/*")
    kinds = incremental.feed_kinds("text")
    path = str(tmp_path / "tally")
    for _ in range(2):
        incremental.tally_stream(changes, path, str(tmp_path / "cp"), F.col("code"), kinds, F.col("sign"))
    full = spark.createDataFrame(left(deltas), "code string, text string, mode string")
    assert rows(incremental.catalog(incremental.merged(spark, path))) == rows(top_descriptions(full, "code", "text"))


def test_nothing_yet_and_more_taken_than_came(spark, tmp_path):
    path = str(tmp_path / "tally")
    assert incremental.catalog(incremental.merged(spark, path)).count() == 0 and incremental.compact(spark, path).count() == 0
    incremental.write_delta(tallied(spark.createDataFrame([("a", "x", None, -1)], SCHEMA)), path, 0)
    assert rows(incremental.overdrawn(incremental.merged(spark, path))) == [("a", "", None, -1), ("a", "description", "x", -1)]
    assert incremental.catalog(incremental.merged(spark, path)).count() == 0


def test_the_catalog_of_a_feed(spark, tmp_path):
    feed = spark.createDataFrame([(" 01", "ACH in"), ("01", "ACH in "), ("02", None), (None, "x")], "TRANCD string, EFHDS1 string")
    path = str(tmp_path / "tally")
    incremental.write_delta(incremental.signed_tally(feed, F.trim("TRANCD"), incremental.feed_kinds("EFHDS1")), path, 0)
    want = catalogs.transaction_catalog(feed, "NON_POS").select("transaction_code", "volume", "description_samples")
    assert rows(incremental.catalog(incremental.merged(spark, path))) == rows(want)
