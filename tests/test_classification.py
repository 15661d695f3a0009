import json
import sys

import pytest
from conftest import rows
from pyspark import cloudpickle
from pyspark.sql import functions as F

from codeloom import schemas
from codeloom.functions.pricing import TRANSACTION_PRICES
from codeloom.operators import batching, inference, labels, lob, profile, rules, taxonomy
from codeloom.plans import classification
# Backends defined here travel with the task.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def now():
    return F.lit("2026-01-01 00:00:00").cast("timestamp")


N, FEE = "Non-fee item", "Fee item"
GOLDEN = {
    "ACH Debit - SERMONS": (N, "Money movement", "ACH", None),
    "ACH Chargeback Fee": (FEE, "All others", "Money movement", "ACH"),
    "ATM Service Charge": (FEE, "All others", "Money movement", "ATM"),
    "ATM Fee": (FEE, "All others", "Money movement", "ATM"),
    "ATM Withdrawal": (N, "Money movement", "ATM", None),
    "ATM Credit Reversal": (N, "Money movement", "ATM", None),
    "ITM-ATM Deposit": (N, "Money movement", "ATM", None),
    "Transfer from DDA": (N, "Money movement", "Transfers & Payments", None),
    "Zelle Credit": (N, "Money movement", "Transfers & Payments", None),
    "Automatic Loan Payment": (N, "Money movement", "Transfers & Payments", None),
    "Credit card payment": (N, "Money movement", "Transfers & Payments", None),
    "Check (On Us)": (N, "Money movement", "Check", None),
    "Official Check": (N, "Money movement", "Check", None),
    "Mobile Deposit": (N, "Money movement", "Deposits", None),
    "HSA Contribution": (N, "Money movement", "Deposits", None),
    "HSA Distribution": (N, "Money movement", "Withdrawals", None),
    "Savings Withdrawal": (N, "Money movement", "Withdrawals", None),
    "Automatic Cash Advance": (N, "Money movement", "Withdrawals", None),
    "Wire Transfer Credit": (N, "Money movement", "Wire", None),
    "Foreign Wire (Incoming)": (N, "Money movement", "Wire", "International"),
    "Domestic wire (Outgoing)": (N, "Money movement", "Wire", "Domestic"),
    "Int Bnking doing a single wire": (N, "Money movement", "Wire", None),
    "Wire Transfer Fee": (FEE, "All others", "Money movement", "Wire"),
    "POS Debit-PIN-DDA": (N, "Money movement", "Debit Card", "POS"),
    "POS Pre-Authorized Debit": (N, "Money movement", "Debit Card", "POS"),
    "NSF Item Paid": (N, "NSF/OD", None, None),
    "Overdraft Fee": (FEE, "NSF/OD", None, None),
    "Insufficient Funds Charge": (FEE, "NSF/OD", None, None),
    "Return Item Fee": (FEE, "NSF/OD", None, None),
    "NSF Fee Refund": (N, "Money movement", "Deposits", None),
    "Refund NSF/OD Fee": (N, "Money movement", "Deposits", None),
    "Closing Withdrawal": (N, "Account operations", "Closing", None),
    "Stop Payment Order": (N, "Account operations", "Fraud & Stop Payment", None),
    "Chargeback Item": (N, "Account operations", "Fraud & Stop Payment", None),
    "Stop Payment Charge": (FEE, "All others", "Account operations", "Misc"),
    "Memo Credit": (N, "Account operations", "Memo Posting", None),
    "Pre-auth Memo Hold": (N, "Account operations", "Memo Posting", None),
    "Interest Deposit": (N, "Account operations", "Interest", None),
    "Federal withholding": (N, "Account operations", "Govt. & Tax", None),
    "Levy": (N, "Account operations", "Govt. & Tax", None),
    "Int Bnking history inquiry": (N, "Account operations", "Integration", None),
    "Encoding Error Credit Adjustment": (N, "Account operations", "Operational", None),
    "CD Redemption": (N, "Account operations", None, None),
    "Cash Management Credit": (N, "Misc", None, None),
    "ZBA credit transfer": (N, "Misc", None, None),
    "Trust account activity": (N, "Misc", None, None),
    "Monthly service charge": (FEE, "Service Charges", None, None),
    "Annual Fee": (FEE, "Service Charges", None, None),
    "Sales Tax on Service Charge": (FEE, "All others", "Account operations", "Misc"),
    "Statement Fee": (FEE, "All others", "Account operations", "Misc"),
    "Dormant Fee": (FEE, "All others", "Account operations", "Misc"),
    "Voice Response Transaction Fee": (FEE, "All others", "Money movement", "Transfers & Payments"),
    "Int to Bal/Raise YTD (EFT Only)": (N, "Account operations", "Integration", None),
    "Insured Cash Sweeps (ICS) Debit": (N, "Account operations", "Integration", None),
    "Check stop payment": (N, "Account operations", "Fraud & Stop Payment", None),
    "Interest Transfer Credit": (N, "Account operations", "Interest", None),
    "Interest charged": (N, "Account operations", "Interest", None),
    "Christmas Club Closing Entry": (N, "Account operations", "Closing", None),
    "HSA Death Distribution": (N, "Account operations", "Closing", None),
    "Contract Collection Reversal": (N, "Account operations", "Operational", None),
    "Transfer to CD": (N, "Money movement", "Transfers & Payments", None),
    "Safe Deposit Rental Payment": (N, "Money movement", "Transfers & Payments", None),
    "Savings Force Pay Deposit": (N, "Money movement", "Deposits", None),
    "Descriptive Debit (EFT)": (N, "Money movement", "Withdrawals", None),
    "ACH Credit Back Item": (N, "Money movement", "ACH", None),
    "Int Bnking ARP file upload": (N, "Misc", None, None),
    "Business Mobile Deposit": (N, "Misc", None, None),
    "Stockholder Dividend Deposit": (N, "Misc", None, None),
    "Fee waiver": (FEE, "Service Charges", None, None),
    "Overdraft fee waiver": (FEE, "NSF/OD", None, None),
    "Balance inquiry fee at foreign ATM": (FEE, "All others", "Money movement", "ATM"),
    "Daily Uncollected Balance Fee": (FEE, "All others", "Account operations", "Misc"),
    "Transit Fee in Service Charge": (FEE, "All others", "Account operations", "Misc"),
    "Safe Deposit Box Annual Rental Fee": (FEE, "Service Charges", None, None),
    "Int Bnking Service Charge": (FEE, "Service Charges", None, None),
    "Overdraft Fee Reversal": (N, "Money movement", "Deposits", None),
    "ATM fee refund": (N, "Money movement", "Deposits", None),
    "Something Fee": (FEE, "Unclassified", None, None),
    "Something else": (N, "Unclassified", None, None),
    "": (N, "Unclassified", None, None),
}


def test_rules_place_known_names(spark):
    df = spark.createDataFrame([(d,) for d in GOLDEN], "d string")
    got = {r["d"]: tuple(r["p"])[:4] for r in df.select("d", rules.transaction_placement("d").alias("p")).collect()}
    assert {d: p for d, p in got.items() if p != GOLDEN[d]} == {}
    for description, path in GOLDEN.items():
        assert rules.place_transaction(description)[0] == path


def test_every_rule_path_is_legal():
    legal = set(taxonomy.transaction_paths())
    for rule in (*rules.FEE_BLOCK, *rules.NON_FEE_RULES):
        assert rule.path in legal, rule
    categories = {p[2] for p in taxonomy.product_paths()}
    assert {r.path[0] for _, _, r in rules.PRODUCT_CATEGORY_RULES} <= categories


def test_scoring_and_direction(spark):
    df = spark.createDataFrame([(N, "NSF/OD"), (N, "Money movement"), (N, "Misc"), (FEE, "NSF/OD"), (None, None)], "a string, b string")
    assert [r[0] for r in df.select(rules.include_in_scoring("a", "b")).collect()] == [True, True, False, False, False]
    texts = ["ACH Credit", "ACH Debit", "Deposit", "whatever", "Credit card purchase", None]
    got = spark.createDataFrame([(t,) for t in texts], "d string").select(rules.direction("d")).collect()
    assert [r[0] for r in got] == ["Credit", "Debit", "Credit", "Debit", "Debit", "Debit"] == [rules.direction_of(t) for t in texts]


def test_product_rules(spark):
    data = [
        ("Personal Checking", "Deposit", None, "Retail", "Deposits", "Checking (DDA)", None, None),
        ("Holiday Club Account", "Deposit", None, "Retail", "Deposits", "Checking (DDA)", None, "Club"),
        ("Money Market Savings", "Deposit", None, "Retail", "Deposits", "Savings", "Money Market", None),
        ("Residential Mortgage Fixed", "Loan", "7", "Retail", "Loans", "Mortgage loans", None, "Fixed"),
        ("Commercial RE Fixed", "Loan", "4", "Business", "Loans", "Real Estate", "Commercial Real Estate", "Fixed"),
        ("Agricultural RE Fixed", "Loan", "11", "Business", "Loans", "Real Estate", "Agricultural Real Estate", "Fixed"),
        ("Overdraft Protection", "Loan", None, "Retail", "Loans", "Personal loans", None, None),
        ("Real Estate Loan", "Loan", "3", "Business", "Loans", "Real Estate", None, None),
        ("Residential RE", "Loan", "4", "Retail", "Loans", "Mortgage loans", None, None),
        ("Mystery", "Loan", None, "Retail", "Loans", "Unclassified", None, None),
    ]
    df = spark.createDataFrame([d[:3] for d in data], "n string, d string, p string")
    got = [tuple(r["r"])[:5] for r in df.select(rules.product_placement("n", "d", "p").alias("r")).collect()]
    assert got == [d[3:] for d in data]


def test_suggestion_rules(spark):
    data = [
        ("Personal Checking (15,000)", "RETAIL", "DEPOSITS", "CHECKING", "PERSONAL CHECKING", None),
        ("Residential RE Fixed (55,577) | x (2)", "RETAIL", "LOANS", "MORTGAGE", "RESIDENTIAL RE FIXED", "FIXED"),
        ("CRE Fixed (14,402)", "BUSINESS", "LOANS", "COMMERCIAL REAL ESTATE", "CRE FIXED", "FIXED"),
        ("Fiduciary Bus Int Ck (9)", "WEALTH MANAGEMENT", "DEPOSITS", "CHECKING", "FIDUCIARY BUS INT CK", None),
        ("Real Estate Loan (3)", "RETAIL", "LOANS", "REAL ESTATE", "REAL ESTATE LOAN", None),
        ("(no description)", "RETAIL", None, None, None, None),
    ]
    df = spark.createDataFrame([(d[0],) for d in data], "s string")
    got = [tuple(r["r"])[:5] for r in df.select(rules.suggestion_placement("s").alias("r")).collect()]
    assert got == [d[1:] for d in data]


def test_labels_and_attributes(spark):
    df = spark.createDataFrame([("ATM fee refund",), ("nothing",), (None,), ("wire transfer and ach",)], "t string")
    got = df.select(labels.flat_label("t", labels.CATEGORY_LABELS).alias("l"), *[c.alias(n) for n, c in labels.attributes("t").items()])
    assert [tuple(r) for r in got.collect()] == [
        ("Money movement", "ATM", False, True, True), (None, None, False, False, False), (None, None, False, False, False),
        ("Money movement", "ACH", False, False, False),
    ]


def test_neighbouring_words_count_each(spark):
    vocabulary = {"a": "the|and|of|for", "b": "stop payment|hold", "c": "fee"}
    texts = ["the and of for fee", "stop payment stop payment fee", "THE.fee,fee/fee", "thefee", "", None, "hold hold hold the the"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in df.select(labels.flat_label("t", vocabulary)).collect()] == ["a", "b", "c", None, None, None, "b"]


def test_purpose_and_class(spark):
    df = spark.createDataFrame([("01", "i"), ("2", "B "), ("07", "T"), ("9", "G"), (None, None)], "p string, c string")
    got = [tuple(r) for r in df.select(rules.purpose_lob("p"), rules.customer_class_lob("c")).collect()]
    assert got == [("Retail", "Retail"), ("Retail", "Business"), (None, "Wealth Management"), ("Business", None), (None, None)]


def test_account_context(spark):
    accounts = spark.createDataFrame([("a1", "01"), ("a2", "03"), ("a3", None)], "AccountNumber string, PURCOD string")
    rel = spark.createDataFrame([("c1", "Primary", "a1"), ("c2", "Joint", "a1"), ("c2", "Primary", "a2")], "CIF string, Relationship string, AccountNumber string")
    customers = spark.createDataFrame([("c1", "I"), ("c2", "C")], "CIF string, CFCLAS string")
    got = lob.accounts_with_customer_class(lob.with_purpose_lob(accounts, "PURCOD"), rel, customers)
    assert rows(got, "AccountNumber", "purpose_lob", "class_lob") == sorted([("a1", "Retail", "Retail"), ("a2", "Business", "Business"), ("a3", None, None)], key=repr)
    tx = spark.createDataFrame([(" 1", 5), ("9", 6)], "acct string, v int")
    types = spark.createDataFrame([("1", "D"), ("1 ", "D")], "internal string, actype string")
    assert rows(lob.transactions_with_account_type(tx, types, "acct", "internal", "actype"), "v", "actype") == [(5, "D"), (6, None)]


# --- batches, backends, answers -----------------------------------------------------------------------------

CATALOG = [("0100", "ACH Credit (5)", 5, "POS", 1), ("0100", "ACH (1)", 1, "NON_POS", 1), ("aB", 'quote " (2)', 2, "POS", 1), ("7", "(no description)", 9, "POS", 3)]


@pytest.fixture(scope="module")
def catalog(spark):
    return spark.createDataFrame(CATALOG, "transaction_code string, description_samples string, volume bigint, source_file string, layer int")


def no_wait(attempt):
    return 0.0


def test_prompt_lines(spark):
    df = spark.createDataFrame([("1", "nan", 3)], "transaction_code string, description_samples string, volume bigint")
    assert df.select(batching.transaction_line()).first()[0] == 'transaction_code=1, SAMPLES="(no description)", VOLUME=3'
    p = spark.createDataFrame(
        [("A", "(unknown)", "Loan", '{"7": 0.5}', None), ("B", " Name", "Deposit", "", None)],
        "product_code string, product_name string, source_file string, purcod_distribution string, purpose_distribution string",
    )
    assert [r[0] for r in p.select(batching.product_line()).collect()] == [
        'product_code=A, DESC="(no description)", DOMAIN=Loan, PURCOD_DIST={"7": 0.5}', 'product_code=B, DESC="Name", DOMAIN=Deposit',
    ]
    s = spark.createDataFrame([("A", " a\x01b\\c ", 7)], "product_code string, description_samples string, volume bigint")
    assert s.select(batching.suggestion_line()).first()[0] == 'product_code=A, SAMPLES="ab\\\\c", VOLUME=7'


def test_native_and_python_backends_agree(catalog):
    native = classification.classify_transactions(catalog, "v1", now())
    python = classification.classify_transactions(catalog, "v1", now(), backend=inference.rule_backend, wait=no_wait)
    assert native.schema.names == schemas.CLASSIFICATION_RESULTS.names == python.schema.names
    same = [c for c in native.columns if c not in ("llm_raw", "tokens_out", "estimated_cost")]
    # The code of two feeds stays two rows, each with its own metadata.
    assert rows(native, *same) == rows(python, *same)
    assert rows(native, "transaction_code", "source_file", "volume") == sorted((c, f, v) for c, _, v, f, _ in CATALOG)
    assert {tuple(r) for r in native.select("transaction_code", "layer").collect()} == {("0100", 1), ("aB", 1), ("7", 3)}


def test_answers_in_other_case_extra_missing_and_null(catalog):
    def backend(prompt, items):
        answers = [{"transaction_code": i["code"].upper(), "category_1": "c", "confidence": None} for i in items if i["code"] != "0100"]
        return json.dumps({"classifications": [*answers, {"transaction_code": "extra", "category_1": "c"}]})

    got = classification.classify_transactions(catalog, "v1", now(), backend=backend, wait=no_wait)
    found = rows(got, "transaction_code", "category_1", "category_2", "volume", "layer", "confidence", "was_requested")
    assert found == sorted([
        ("AB", "c", None, 2, 1, None, True), *[("extra", "c", None, 0, 3, None, False)] * 3,
        ("7", "c", None, 9, 3, None, True), ("0100", "ERROR", inference.OMITTED, 5, 1, 0.0, True), ("0100", "ERROR", inference.OMITTED, 1, 1, 0.0, True),
    ], key=repr)


def test_every_item_gets_one_answer_or_one_error(spark):
    items = [("x", "s1", 1, "A", 1), ("X ", "s2", 2, "A", 1), ("y", "s3", 4, "A", 1), (None, "s4", 8, "A", 1)]
    catalog = spark.createDataFrame(items, "transaction_code string, description_samples string, volume bigint, source_file string, layer int")

    def backend(prompt, items):
        codes = ["X", None, "x", "x", "z"]
        return json.dumps({"classifications": [{"transaction_code": c, "category_1": f"a{i}"} for i, c in enumerate(codes)]})

    got = classification.classify_transactions(catalog, "v1", now(), backend=backend, wait=no_wait)
    found = rows(got, "transaction_code", "category_1", "volume", "was_requested")
    # The two items of code X get the first two answers; the third, the null and the unknown code belong to no item.
    assert sorted(r[2] for r in found if r[3]) == [1, 2, 4, 8]
    assert sorted((r[0], r[1]) for r in found if not r[3]) == [("", "a1"), ("x", "a3"), ("z", "a4")]
    assert sorted(r[2] for r in found if r[1] == "ERROR") == [4, 8]


def test_batches_are_spread_over_tasks(spark):
    requests = spark.range(2000).select(
        F.col("id").cast("string").alias("batch_id"), F.lit("p").alias("prompt"),
        F.array(F.struct(F.col("id").cast("string").alias("code"))).alias("items"),
    )

    def backend(prompt, items):
        from pyspark import TaskContext

        return str(TaskContext.get().partitionId())

    answered = inference.ask(requests, backend, wait=no_wait)
    assert answered.count() == 2000 and answered.select("raw_response").distinct().count() > 32


def test_unreadable_answer_fails_the_batch(catalog):
    got = classification.classify_transactions(catalog, "v1", now(), backend=lambda p, i: "no json", wait=no_wait)
    assert {tuple(r) for r in got.select("category_1", "category_2", "confidence").collect()} == {("ERROR", "unreadable response", 0.0)}
    assert got.count() == 4


def test_retries_then_error_rows(catalog, tmp_path):
    log = tmp_path / "calls"

    def backend(prompt, items):
        with open(log, "a") as out:
            out.write(items[0]["code"] + items[0]["source_file"] + "\n")
        if items[0]["code"] == "7":
            raise RuntimeError("boom " + "x" * 300)
        if open(log).read().split().count(items[0]["code"] + items[0]["source_file"]) < 3:
            raise RuntimeError("flaky")
        return inference.rule_backend(prompt, items)

    got = classification.classify_transactions(catalog, "v1", now(), backend=backend, wait=no_wait)
    by_code = {r["transaction_code"]: r for r in got.collect()}
    assert by_code["0100"]["category_1"] == N
    failed = by_code["7"]
    assert failed["category_1"] == "ERROR" and failed["category_2"] == "boom " + "x" * 300
    assert (failed["tokens_in"], failed["estimated_cost"], failed["confidence"]) == (0, 0.0, 0.0)
    # Three attempts each, and the kept answers are not asked for again.
    assert got.count() == 4
    assert sorted(open(log).read().split()) == ["0100NON_POS"] * 3 + ["0100POS"] * 3 + ["7POS"] * 3
    assert [inference.wait_seconds(a) for a in (1, 2)] == [2.0, 4.0]


def test_costs_follow_characters(catalog):
    got = classification.classify_transactions(catalog, "v1", now(), model="large").filter("transaction_code = '7'").first()
    assert got["tokens_out"] == len(got["llm_raw"]) // 4
    price_in, price_out = TRANSACTION_PRICES["large"]
    assert abs(got["estimated_cost"] - (got["tokens_in"] * price_in + got["tokens_out"] * price_out) / 1000) < 1e-12


def test_products_through_python(spark):
    df = spark.createDataFrame(
        [("A", "Auto Loan", 5, "Loan", None, None, 1), ("A", "Basic Checking", 3, "Deposit", None, None, 2)],
        "product_code string, product_name string, account_count bigint, source_file string, purcod_distribution string, purpose_distribution string, layer int",
    )

    def backend(prompt, items):
        return json.dumps({"classifications": [{"product_code": i["code"], "line_of_business": "Retail", "confidence": 1, "reasoning": "r"} for i in items]})

    got = classification.classify_products(df, "p1", now(), backend=backend, wait=no_wait)
    assert got.schema.names == schemas.PRODUCT_CLASSIFICATION_RESULTS.names
    assert rows(got, "product_code", "source_file", "account_count", "layer", "batch_id", "line_of_business", "reasoning") == [
        ("A", "Deposit", 3, 2, "Deposit-0", "Retail", "r"), ("A", "Loan", 5, 1, "Loan-0", "Retail", "r"),
    ]


def test_result_slices(spark):
    df = spark.createDataFrame([("a", "ERROR", 0.0), ("b", "x", 0.5), ("c", "x", 0.9)], "code string, category_1 string, confidence double")
    assert inference.valid_rows(df, "category_1").count() == 2
    assert inference.error_rows(df, "category_1").count() == 1
    assert rows(inference.low_confidence(df, "category_1"), "code") == [("b",)]


def test_profile_labels(spark):
    data = [(i, str(100 + i), "text %d" % i, "1.5", "2026-01-0%d" % (i + 1), "", "12345") for i in range(6)]
    df = spark.createDataFrame(data, "rn int, TRANCD string, EFHDS1 string, AMT string, TRDATE string, description string, ACCT string")
    profiles = profile.profile_columns(df, "rn")
    assert {r["column"]: r["kind"] for r in profiles.collect()} == {
        "TRANCD": "small integers", "EFHDS1": "text", "AMT": "decimal numbers", "TRDATE": "dates (YYYY-MM-DD)", "description": "empty", "ACCT": "integers",
    }
    mapping = profile.map_columns(profiles)
    assert {r["client_column"]: r["canonical_column"] for r in mapping.collect()} == {
        "TRANCD": "transaction_code", "EFHDS1": "description_1", "description": "transaction_desc",
    }
    assert profile.twice_used(mapping).count() == 0
    assert profile.as_names(mapping)["EFHDS1"] == "description_1"
    stored = profile.mapping_table(mapping, now())
    assert [(f.name, f.dataType) for f in stored.schema] == [(f.name, f.dataType) for f in schemas.COLUMN_MAPPINGS]


def test_illegal_paths(spark):
    df = spark.createDataFrame([("fee ITEM", "all others", "n/a", None), ("Fee item", "Wire", None, None)], "a string, b string, c string, d string")
    assert rows(taxonomy.illegal_predictions(df, ["a", "b", "c", "d"], taxonomy.transaction_paths()), "b") == [("Wire",)]
