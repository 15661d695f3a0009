import datetime as dt

import pytest
from conftest import rows
from pyspark.sql import functions as F

from codeloom import schemas
from codeloom.functions.levels import PRODUCT
from codeloom.operators import audits
from codeloom.operators.frequency import status_most_common
from codeloom.operators.normalize import conform
from codeloom.plans import account_history, catalogs, suggestions
from codeloom.plans.uncategorized import uncategorized_catalog

HISTORY = "ProductInstanceReference string, ProductInstanceDescription string, AccountStatus string, valid_to timestamp"


def stamp():
    return F.lit("2026-01-01 00:00:00").cast("timestamp")


def history(spark):
    ended = dt.datetime(2025, 1, 1)
    data = [(" ck", "Checking", "active ", None)] * 3 + [("CK ", "Checking B", "Closed", ended)] + [
        ("SV", "Savings", "Closed", None), ("SV", None, "Dormant", None), ("SV", " ", None, None), ("zz", "known", "Active", None),
        (None, "x", "Active", None), ("  ", "x", "Active", None), ("QQ", "nan", "Odd", None),
    ]
    return spark.createDataFrame(data, HISTORY)


def master(spark):
    return spark.createDataFrame([("1", " ZZ "), ("2", None)], "PROD_product_type_id string, PROD_core_system_mapping string")


def test_uncategorized_codes(spark):
    got = uncategorized_catalog(history(spark), master(spark))
    assert rows(got, "product_code", "volume", "prod_status", "description_samples") == [
        ("CK", 4, "ACTIVE", "Checking (3) | Checking B (1)"), ("QQ", 1, "INACTIVE", "(no description)"), ("SV", 3, "INACTIVE", "Savings (1)"),
    ]
    current = uncategorized_catalog(history(spark), master(spark), current_only=True, status_rule=status_most_common)
    assert rows(current, "product_code", "volume", "prod_status") == [("CK", 3, "ACTIVE"), ("QQ", 1, "ACTIVE"), ("SV", 3, "INACTIVE")]
    nothing = uncategorized_catalog(history(spark).filter("false"), master(spark))
    assert suggestions.suggest(nothing, "v", stamp()).count() == 0


def test_suggestions_routing_and_audits(spark):
    data = [("CK", 4, "ACTIVE", "Personal Checking (3)"), ("F1", 2, "INACTIVE", "Fiduciary Bus Int Ck (9)"), ("R1", 7, "ACTIVE", "Auto Loan (7)")]
    catalog = spark.createDataFrame(data, "product_code string, volume bigint, prod_status string, description_samples string")
    got = suggestions.suggest(catalog, "v2.0", stamp())
    assert [(f.name, f.dataType) for f in got.schema] == [(f.name, f.dataType) for f in schemas.PRODUCT_SUGGESTIONS]
    assert rows(got, "PROD_core_system_mapping", "PROD_line_of_business", "review_status", "PROD_balance_requires_abs", "PROD_status") == [
        ("CK", "RETAIL", "PENDING_REVIEW", False, "ACTIVE"), ("F1", "WEALTH MANAGEMENT", "REQUIRES_MANUAL_MAPPING", False, "INACTIVE"),
        ("R1", "RETAIL", "PENDING_REVIEW", True, "ACTIVE"),
    ]
    assert audits.suggestion_audits(got).filter("not passed").count() == 0
    bad = got.withColumn("PROD_status", F.lit("GONE")).withColumn("confidence", F.lit(1.5)).unionByName(got)
    failed = audits.suggestion_audits(bad).filter("not passed")
    assert rows(failed, "audit", "column", "failing_rows") == [
        ("accepted_range", "confidence", 3), ("accepted_values", "PROD_status", 3), ("unique_combination", "PROD_product_type_id", 3),
    ]


def test_omitted_and_failed_suggestions_stay_visible(spark):
    catalog = spark.createDataFrame([("ck", 4, "ACTIVE", "x (3)"), ("SV", 2, "ACTIVE", "y (1)")], "product_code string, volume bigint, prod_status string, description_samples string")

    def entry(item):
        return F.struct(F.when(item["code"] == "SV", F.lit("other")).otherwise(item["code"]).alias("PROD_core_system_mapping"),
                        F.lit(" trust ").alias("PROD_line_of_business"), F.lit("loans").alias("PROD_product_category"))

    from codeloom.operators import batching, inference

    batched = batching.assign_batches(catalog, None, ["product_code"], 30)
    requests = batching.batch_requests(batched, batching.suggestion_line(), {"code": "product_code", "description_samples": "description_samples", "volume": "volume", "prod_status": "prod_status"})
    answers = inference.read_answers(
        inference.answer_with(requests, entry).withColumn("model_name", F.lit("m")), schemas.SUGGESTION_RESPONSE, "PROD_core_system_mapping",
        {"description_samples": F.lit(""), "volume": F.lit(0).cast("bigint"), "prod_status": F.lit("ACTIVE")},
    )
    got = suggestions.suggestion_rows(answers, "v", stamp())
    assert rows(got, "PROD_core_system_mapping", "PROD_line_of_business", "review_status", "description_samples", "volume", "PROD_balance_requires_abs") == [
        ("CK", "TRUST", "REQUIRES_MANUAL_MAPPING", "x (3)", 4, True), ("OTHER", "TRUST", "REQUIRES_MANUAL_MAPPING", "", 0, True),
        ("SV", None, "NEEDS_MANUAL_REVIEW", "ERROR: LLM omitted this code from response", 2, False),
    ]


def test_master_merge(spark):
    def frame(data, schema):
        return conform(spark.createDataFrame(data, "PROD_product_type_id string, PROD_core_system_mapping string, PROD_line_of_business string, review_status string"), schema)

    old = frame([("1", " ck ", "RETAIL", None), ("2", "SV", "RETAIL", None)], schemas.PRODUCT_MASTER)
    new = frame([("n1", "CK", "BUSINESS", "APPROVED"), ("n2", "MM", "RETAIL", "APPROVED"), ("n3", "XX", "RETAIL", "REJECTED")], schemas.PRODUCT_SUGGESTIONS)
    got = suggestions.merge_approved(old, new)
    assert got.columns == schemas.PRODUCT_MASTER.names
    assert rows(got, "PROD_product_type_id", "PROD_core_system_mapping", "PROD_line_of_business") == [
        ("1", " ck ", "BUSINESS"), ("2", "SV", "RETAIL"), ("n2", "MM", "RETAIL"),
    ]


def test_exception_report(spark):
    catalog = spark.createDataFrame([("a", 5), ("b", 9), ("c", 1)], "code string, volume int")
    known = spark.createDataFrame([(" A",)], "code string")
    got = suggestions.exception_report(catalog, known, "code", "volume").collect()
    assert [tuple(r) for r in got] == [("b", 9, "Unclassified"), ("c", 1, "Unclassified")]


TYPES = "code string, description string, rn int"


def test_deposit_and_loan_catalogs(spark):
    dep = spark.createDataFrame([("1", "01 "), ("9", "01"), ("2", "01"), ("1", None), ("1", "C1"), ("x", "C1")], "STATUS string, SCCODE string")
    types = spark.createDataFrame([("01", "Free Checking", 1)], TYPES)
    deposits = catalogs.deposit_catalog(dep, types)
    assert rows(deposits, "product_code", "account_count", "product_name", "source_file") == [("01", 2, "Free Checking", "Deposit"), ("C1", 1, "(unknown)", "Deposit")]
    data = [
        ("a1", "R1 ", "1", "7", "Conv", "Resi", 1), ("a1", "R1", "1", "2", "Other", "Later", 2), ("a2", "R1", "3", "7.0", " ", None, 1),
        ("a3", "R1", "2", "1", "x", "closed", 1), ("a4", "ZZ", "1", None, None, None, 1), ("a5", "A2", "1", "4", "Biz", "Auto", 1),
    ]
    loans_ = spark.createDataFrame(data, "acctno string, type string, STATUS string, PURCOD string, PurposeDescription string, LoanTypeDesc string, snap int")
    loans = catalogs.loan_catalog(loans_, spark.createDataFrame([("A2", "Listed auto", 1)], TYPES), ["snap"])
    cols = ("product_code", "account_count", "product_name", "purcod_distribution", "purpose_distribution", "sample_loan_type_desc")
    assert rows(loans, *cols) == [
        ("A2", 1, "Listed auto", '{"4": 1.0}', '{"Biz": 1.0}', "Auto"), ("R1", 2, "Resi", '{"7": 1.0}', '{"Conv": 1.0}', "Resi"),
        ("ZZ", 1, "(unknown)", None, None, None),
    ]
    truth = spark.createDataFrame([("01", *["x"] * 5), ("R1", *["x"] * 5), ("R1", *["y"] * 5)], "product_code string, " + ", ".join(f"{c} string" for c in PRODUCT.truth))
    both = catalogs.combined_product_catalog([deposits, loans], truth)
    assert rows(both, "product_code", "layer") == [("01", 1), ("A2", 3), ("C1", 3), ("R1", 2), ("ZZ", 3)]
    assert set(both.columns) == set(schemas.PRODUCT_CATALOG.names)


def test_transaction_catalog(spark):
    feed = spark.createDataFrame([("0163 ", "AC", "", "secret"), ("0163", "AC", "", "s"), ("7", None, "POS Debit", "s")], "TRANCD string, EFHDS1 string, description string, ACCTNO string")
    got = catalogs.transaction_catalog(feed, "NON_POS")
    assert rows(got) == [("0163", 2, "AC (2)", "NON_POS"), ("7", 1, "(no description)", "NON_POS")]
    pos = catalogs.transaction_catalog(feed, "POS", text="transaction_desc")
    truth = spark.createDataFrame([("7", "a", None, None, None)], "transaction_code string, gt_L1 string, gt_L2 string, gt_L3 string, gt_L4 string")
    both = catalogs.combined_transaction_catalog([got, pos], truth)
    assert rows(both, "transaction_code", "source_file", "layer") == [("0163", "NON_POS", 3), ("0163", "POS", 3), ("7", "NON_POS", 1), ("7", "POS", 1)]


def test_account_history(spark):
    dep = spark.createDataFrame(
        [("D1", "01", "1", "b", "1/5/2024", None, 1), ("D1", "02", "2", "b", "x", None, 2), ("D2 ", " 01", "8", None, "2024-02-03", "20250101", 3)],
        "ACCTNO string, SCCODE string, STATUS string, AccountBranch string, Account_opened_date string, account_close_date string, o int",
    )
    loans = spark.createDataFrame([("L1", "R1", "nan", "3", "6.125", 1), ("L2", "R1", "Own", "0", "bad", 2)], "acctno string, type string, LoanTypeDesc string, STATUS string, RATE string, o int")
    types = spark.createDataFrame([("01", "Free", 1), ("R1", "Resi", 1)], TYPES)
    d = account_history.deposit_history(dep, types, ["o"], stamp())
    ln = account_history.loan_history(loans, types, ["o"], stamp())
    assert d.schema.names == schemas.ACCOUNT_HISTORY.names == ln.schema.names
    got = account_history.account_history(d, ln)
    cols = ("AccountIdentifier", "ProductInstanceReference", "ProductInstanceDescription", "AccountStatus", "AccountOpeningDate", "InterestRate")
    shown = [(a, b, c, s, str(o) if o else None, float(r) if r is not None else None) for a, b, c, s, o, r in rows(got, *cols)]
    assert shown == [
        ("D1", "01", "Free", "ACTIVE", "2024-01-05", None), ("D2", "01", "Free", "CLOSED", "2024-02-03", None),
        ("L1", "R1", "Resi", "DORMANT", None, 6.125), ("L2", "R1", "Own", "ACTIVE", None, None),
    ]
    assert account_history.account_history(d, ln, 1).count() == 2
    assert account_history.account_history(d, ln).count() == 4


def test_required_columns(spark):
    with pytest.raises(ValueError, match="missing columns"):
        audits.require_columns(spark.range(1), ["id", "layer"])
    assert rows(audits.row_count(spark.range(0), "t")) == [("row_count", "t", 1, False)]
