import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from codeloom.functions.levels import PRODUCT, TRANSACTION, VALID_LOB, first_miss, informational_miss, match_names
from codeloom.operators import evaluation, layers, matching, versions
from codeloom.sources import tables

NULLS = ("", "none", "nan", "null", "n/a")


def canon(v):
    if v is None or v.strip().lower() in NULLS:
        return "__null__"
    return v.strip().lower()


def lenient(p, t):
    return canon(t) == "__null__" or canon(p) == canon(t)


def strict(p, t):
    return canon(p) == canon(t)


def value(rng):
    return rng.choice([None, "a", "A ", "b", "c", "n/a"])


@pytest.mark.parametrize("spec", [TRANSACTION, PRODUCT])
def test_any_mapping_equals_brute_force(spark, spec):
    rng = random.Random(spec.depth)
    # One code holds a third of both sides.
    codes = ["hot"] * 5 + [f"c{i}" for i in range(10)]
    pred = [(i, rng.choice(codes), *[value(rng) for _ in spec.pred]) for i in range(150)]
    truth = [(rng.choice(codes[:-2]), *[value(rng) for _ in spec.truth]) for _ in range(120)]
    p = spark.createDataFrame(pred, "id int, code string, " + ", ".join(f"{c} string" for c in spec.pred))
    t = spark.createDataFrame(truth, "code string, " + ", ".join(f"{c} string" for c in spec.truth))
    rule = lenient if spec.lenient_any else strict
    want = []
    for i, code, *values in pred:
        hits = [[rule(a, b) for a, b in zip(values, path)] for c, *path in truth if c == code]
        decisive = [h[: spec.decisive] for h in hits]
        row = [i, max((sum(h) for h in decisive), default=0), any(all(h) for h in decisive)]
        if spec.decisive < spec.depth:
            row.append(any(all(h) for h in hits))
        want.append(tuple(row))
    got = matching.with_agreement(p, t, spec, "code")
    flags = ["best_levels_matched", "exact_match_any"] + (["full_match_any"] if spec.decisive < spec.depth else [])
    assert rows(got, "id", *flags) == sorted(want, key=repr)


@pytest.mark.parametrize("lenient", [False, True])
def test_any_mapping_with_more_paths_than_a_word_holds(spark, lenient):
    rng = random.Random(9)
    letters = [None, *(f"v{i}" for i in range(9))]
    truth = [("hot", *[rng.choice(letters) for _ in range(5)]) for _ in range(700)] + [("c", *["x"] * 5)] * 100
    pred = [(i, rng.choice(["hot", "c", "none"]), *[rng.choice([*letters, "x"]) for _ in range(5)]) for i in range(120)]
    p = spark.createDataFrame(pred, "id int, code string, " + ", ".join(f"{c} string" for c in PRODUCT.pred))
    t = spark.createDataFrame(truth, "code string, " + ", ".join(f"{c} string" for c in PRODUCT.truth))
    rule = globals()['lenient'] if lenient else strict
    want = []
    for i, code, *values in pred:
        hits = [[rule(a, b) for a, b in zip(values, path)] for c, *path in truth if c == code]
        want.append((i, max((sum(h[:3]) for h in hits), default=0), any(all(h) for h in hits)))
    got = matching.with_agreement(p, t, PRODUCT, "code", lenient)
    assert rows(got, "id", "best_levels_matched", "full_match_any") == sorted(want, key=repr)
    assert matching.path_bitmaps(t, "code", PRODUCT.truth).filter("code = 'hot'").count() == 11


def truth_frame(spark, data):
    return spark.createDataFrame(data, "transaction_code string, gt_desc string, gt_L1 string, gt_L2 string, gt_L3 string, gt_L4 string, o int")


PRED_SCHEMA = (
    "prompt_version string, transaction_code string, source_file string, volume bigint, layer int, category_1 string, "
    "category_2 string, category_3 string, category_4 string, confidence double"
)


def pred_row(code, layer, path, volume=10, version="v1"):
    return (version, code, "POS", volume, layer, *path, 0.9)


@pytest.fixture(scope="module")
def small(spark):
    truth = truth_frame(spark, [
        ("1", "first", "Fee item", "NSF/OD", None, None, 1), ("1", "second", "Fee item", "NSF/OD", None, None, 2),
        ("2", "x", "Fee item", "All others", "A", None, 1), ("2", "y", "Fee item", "All others", "A", "B", 2),
        ("3", "z", "Non-fee item", "Misc", None, None, 1),
        ("4", "w", "Non-fee item", "Money movement", "ACH", None, 1),
    ])
    pred = spark.createDataFrame([
        pred_row("1", 1, (" fee ITEM", "nsf/od", "anything", None), 30),
        pred_row("3", 1, ("Fee item", "Misc", None, None), 20),
        pred_row("4", 1, ("Non-fee item", "Money movement", "Wire", None), 50),
        pred_row("2", 2, ("Fee item", "All others", "a", "n/a"), 5),
        pred_row("9", 3, ("Fee item", "Unclassified", None, None), 7),
        pred_row("8", 1, ("Fee item", "Unclassified", None, None), 1),
        pred_row("7", 2, ("Fee item", "Unclassified", None, None), 2),
    ], PRED_SCHEMA)
    return pred, truth


def test_layers_count_paths_that_hold_nulls(spark, small):
    _, truth = small
    catalog = spark.createDataFrame([("1", 3), ("2", 4), ("9", 13)], "transaction_code string, volume int")
    layered = layers.assign_layers(catalog, truth, "transaction_code", TRANSACTION.truth)
    assert rows(layered, "transaction_code", "layer") == [("1", 1), ("2", 2), ("9", 3)]
    assert rows(layers.layer_summary(layered, "transaction_code", "volume")) == [
        (1, "Obvious", 1, 3, 15.0), (2, "Ambiguous", 1, 4, 20.0), (3, "Unknown", 1, 13, 65.0),
    ]
    assert rows(layers.truth_coverage(catalog, truth, "transaction_code")) == [(2, 1, 0.666667)]


def test_evaluation_table(small):
    pred, truth = small
    table = evaluation.evaluate(pred, truth, TRANSACTION, "transaction_code", ["gt_desc"], ["o"])
    got = rows(table, "transaction_code", "match_L1", "exact_match", "failure_type", "review_status")
    assert got == sorted([
        ("1", True, True, None, "EVALUATED"), ("3", False, False, "WRONG BLOCK (L1)", "EVALUATED"),
        ("4", True, False, "WRONG CHANNEL (L3)", "EVALUATED"), ("2", None, True, None, "EVALUATED"),
        ("9", None, None, None, "NEEDS MANUAL REVIEW"), ("8", True, True, None, "EVALUATED"),
        ("7", None, False, "AMBIGUOUS_NO_MATCH", "EVALUATED"),
    ], key=repr)
    assert [(f.name, f.dataType.simpleString()) for f in table.schema if f.name in ("exact_match", "match_L1")] == [("match_L1", "boolean"), ("exact_match", "boolean")]


def test_unique_truth_keeps_the_first_description(small):
    _, truth = small
    profile = matching.truth_profile(truth, "transaction_code", TRANSACTION, ["gt_desc"], ["o"])
    got = {r["transaction_code"]: (r["n_mappings"], r["gt_desc"]) for r in profile.collect()}
    assert got == {"1": (1, "first"), "2": (2, None), "3": (1, "z"), "4": (1, "w")}


def test_metrics(spark, small):
    pred, truth = small
    one = evaluation.layer_one(pred, truth, TRANSACTION, "transaction_code", ["gt_desc"], ["o"])
    got = evaluation.accuracy(one, ["exact_match"], "volume").first().asDict()
    assert got == {"codes": 4, "weight": 101, "exact_match": 0.5, "w_exact_match": round(31 / 101, 6)}
    equal = one.withColumn("volume", F.lit(1))
    same = evaluation.accuracy(equal, ["match_L3"], "volume").first()
    assert same["match_L3"] == same["w_match_L3"]
    nothing = evaluation.accuracy(one.filter("false"), ["exact_match"], "volume").first()
    assert nothing["w_exact_match"] == 0.0 and nothing["exact_match"] is None
    wrong = rows(evaluation.mismatches(one, TRANSACTION, "transaction_code"))
    assert wrong == [("3", "L1", "Fee item", "Non-fee item"), ("4", "L3", "Wire", "ACH")]
    status = spark.range(1).select(evaluation.target_status(F.lit(0.8)), evaluation.target_status(F.lit(0.79))).first()
    assert tuple(status) == ("MET", "BELOW TARGET")


def test_failures_and_kpi(small):
    pred, truth = small
    table = evaluation.evaluate(pred, truth, TRANSACTION, "transaction_code", ["gt_desc"], ["o"])
    assert rows(evaluation.failure_distribution(table, "transaction_code", "volume")) == [
        ("AMBIGUOUS_NO_MATCH", 1, 2, "7"), ("WRONG BLOCK (L1)", 1, 20, "3"), ("WRONG CHANNEL (L3)", 1, 50, "4"),
    ]
    kpi = evaluation.kpi(table, TRANSACTION, "volume").first().asDict()
    assert (kpi["codes"], kpi["l1_codes"], kpi["l2_codes"], kpi["l3_codes"], kpi["l1_weight"]) == (7, 4, 2, 1, 101)
    assert (kpi["exact_match"], kpi["l2_any_match"], kpi["target"]) == (0.5, 0.5, "BELOW TARGET")


def test_product_rules(spark):
    t = "product_code string, product_name string, " + ", ".join(f"{c} string" for c in PRODUCT.truth) + ", o int"
    truth = spark.createDataFrame([
        ("A", "n", "Retail", "Deposits", "Savings", "Basic", "HSA", 1), ("B", "n", "Retail", "Loans", None, "X", None, 1),
        ("C", "n", " Business ", "Loans", "Real Estate", None, None, 1), ("W", "n", "Wealth Management", "Securities", "Loans", None, None, 1),
        ("E", "n", None, None, "Savings", None, None, 1),
    ], t)
    p = "product_code string, source_file string, account_count bigint, layer int, " + ", ".join(f"{c} string" for c in PRODUCT.pred)
    pred = spark.createDataFrame([
        ("A", "Deposit", 1, 1, "retail", "deposits", "savings", "Premium", None), ("B", "Loan", 1, 1, "RETAIL", "Loans", "any", "X", "any"),
        ("C", "Loan", 1, 1, "Retail", "Loans", "Real Estate", None, None), ("W", "Loan", 1, 1, "Retail", "Loans", "x", None, None),
        ("E", "Loan", 1, 1, "Retail", "Loans", "x", None, None),
    ], p)
    valid = matching.supported_lob(truth, PRODUCT.truth[0], VALID_LOB)
    assert matching.unsupported_lob(truth, PRODUCT.truth[0], VALID_LOB).count() == 1
    table = evaluation.evaluate(pred, valid, PRODUCT, "product_code", ["product_name"], ["o"], exclude_missing=True)
    got = rows(table, "product_code", "canonical_match", "full_match", "exact_match", "failure_type", "review_status")
    assert got == [
        ("A", True, False, True, "MISMATCH L4+L5", "EVALUATED"), ("B", True, True, True, None, "EVALUATED"),
        ("C", False, False, False, "WRONG LOB (L1)", "EVALUATED"), ("W", None, None, None, "GT_LOB_EXCLUDED", "GT_LOB_EXCLUDED"),
    ]


def test_miss_labels(spark):
    df = spark.createDataFrame([(True, True, False, True, False), (True, True, True, False, True), (True,) * 5], ", ".join(f"match_L{i} boolean" for i in range(1, 6)))
    got = [tuple(r) for r in df.select(first_miss(PRODUCT), informational_miss(PRODUCT)).collect()]
    assert got == [("WRONG CATEGORY (L3)", "MISMATCH L5"), (None, "MISMATCH L4"), (None, None)]
    assert "canonical_match" in match_names(PRODUCT) and "canonical_match" not in match_names(TRANSACTION)


def test_costs_count_each_batch_once(spark):
    data = [("b1", 100, 50, 0.5)] * 3 + [("b2", 10, 5, 0.1)]
    df = spark.createDataFrame(data, "batch_id string, tokens_in int, tokens_out int, estimated_cost double")
    got = evaluation.batch_costs(df).first().asDict()
    assert got == {"codes": 4, "batches": 2, "tokens_in": 110, "tokens_out": 55, "estimated_cost": 0.6, "cost_by_rows": 1.6, "cost_per_code": 0.15}


def test_saving_one_version_keeps_the_others(spark, tmp_path):
    path = f"{tmp_path}/results"

    def version(tag, rows_, stamp):
        return spark.createDataFrame([(c, stamp, "b", 1.0) for c in rows_], "code string, run_timestamp string, batch_id string, estimated_cost double").withColumn("prompt_version", F.lit(tag))

    tables.save_results(version("v1", "ab", "2026-01-01"), path)
    tables.save_results(version("v2", "abc", "2026-02-01"), path)
    tables.save_results(version("v2", "a", "2026-03-01"), path)
    stored = tables.load(spark, path)
    assert rows(stored.groupBy("prompt_version").count()) == [("v1", 2), ("v2", 1)]
    assert versions.latest_version(stored).first()[0] == "v2"
    assert versions.of_version(stored).count() == 1
    assert versions.of_version(stored, "v1").count() == 2
    pruned = tables.load_version(spark, path, "v1")
    assert pruned.count() == 2
    assert "PartitionFilters: [isnotnull(prompt_version" in pruned._jdf.queryExecution().executedPlan().toString()
    assert [r[0] for r in versions.versions(stored).collect()] == ["v1", "v2"]
