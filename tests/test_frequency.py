import json
from collections import Counter

from conftest import rows
from pyspark.sql import functions as F

from codeloom.operators import frequency


def test_top_descriptions_format_ties_and_blanks(spark):
    data = [("1", " b "), ("1", "a"), ("1", "nan"), ("1", ""), ("1", None), ("1", "c"), ("1", "c"), ("2", None), ("2", "None")]
    data += [("3", "big")] * 1234 + [(None, "x")]
    df = spark.createDataFrame(data, "code string, t string")
    got = {r["code"]: (r["volume"], r["description_samples"]) for r in frequency.top_descriptions(df, "code", "t", 2).collect()}
    assert got == {"1": (7, "c (2) | a (1)"), "2": (2, "(no description)"), "3": (1234, "big (1,234)")}


def test_distribution_json_shares_divide_by_all_valid_rows(spark):
    values = [7] * 6 + [2] * 3 + [3] * 2 + [4] * 2 + [5, 6, 10]
    data = [("A", str(v), "p%d" % (v % 2), i) for i, v in enumerate(values)] + [("A", None, " ", 99), ("B", None, None, 100)]
    df = spark.createDataFrame(data, "code string, v string, t string, o int")
    out = frequency.distributions_json(
        df, "code", {"d": F.col("v").cast("bigint"), "e": F.when(F.trim("t") != "", F.col("t"))}, F.col("t"), ["o"]
    )
    got = {r["code"]: r.asDict() for r in out.collect()}
    top = sorted(Counter(values).items(), key=lambda kv: (-kv[1], kv[0]))[:5]
    assert got["A"]["d"] == json.dumps({str(k): round(n / len(values), 3) for k, n in top})
    assert got["A"]["rows"] == len(values) + 1
    assert got["A"]["first"] == "p1"
    assert json.loads(got["A"]["e"]) == {"p0": round(sum(v % 2 == 0 for v in values) / 16, 3), "p1": round(sum(v % 2 for v in values) / 16, 3)}
    assert got["B"] == {"code": "B", "rows": 1, "first": None, "d": None, "e": None}


def test_distribution_rounds_half_even(spark):
    df = spark.createDataFrame([("A", "x")] + [("A", "y")] * 15, "code string, v string")
    shares = {r["v"]: r["share"] for r in frequency.distribution(df, "code", "v").collect()}
    assert shares == {"x": 0.062, "y": 0.938}


def test_first_sample_skips_null_and_follows_the_order(spark):
    df = spark.createDataFrame([("a", None, 1), ("a", "late", 3), ("a", "early", 2), ("b", None, 1)], "c string, v string, o int")
    got = {r["c"]: r["v"] for r in df.groupBy("c").agg(frequency.first_sample("v", ["o"]).alias("v")).collect()}
    assert got == {"a": "early", "b": None}


def test_status_rules_differ_on_unknown_states(spark):
    df = spark.createDataFrame(
        [("a", "ACTIVE"), ("a", "CLOSED"), ("b", "CLOSED"), ("b", "DORMANT"), ("c", "WHO"), ("d", None), ("e", "WHO"), ("e", "CLOSED")],
        "c string, s string",
    )
    got = df.groupBy("c").agg(
        frequency.status_any_active(F.col("s")).alias("x"), frequency.status_most_common(F.col("s")).alias("y")
    )
    assert rows(got) == [
        ("a", "ACTIVE", "ACTIVE"), ("b", "INACTIVE", "INACTIVE"), ("c", "INACTIVE", "ACTIVE"), ("d", "INACTIVE", "ACTIVE"),
        ("e", "INACTIVE", "INACTIVE"),
    ]


def test_value_counts_keep_or_drop_null(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,)], "v string")
    assert [tuple(r) for r in frequency.value_counts(df, "v").collect()] == [("a", 2)]
    assert frequency.value_counts(df, "v", keep_null=True).count() == 2
    assert frequency.distinct_codes(df, "v").first()["codes"] == 1
    assert frequency.distinct_codes(df, "v", approximate=True).first()["codes"] == 1
    assert [r["v"] for r in frequency.sorted_distinct(df, "v").collect()] == ["a"]
