"""Files in, reports out: both pipelines and the suggestion loop."""

from conftest import rows
from pyspark.sql import functions as F

from codeloom import schemas
from codeloom.functions.levels import PRODUCT, TRANSACTION, VALID_LOB
from codeloom.operators import audits, evaluation, matching, profile, versions
from codeloom.operators.normalize import conform
from codeloom.plans import account_history, catalogs, classification, ground_truth, suggestions, uncategorized
from codeloom.sources import delimited, ragged, tables

TRUTH = """External Transaction Description,External Transaction Code,Fee Item Description,Internal Fee Item Code,Credit / Debit,Scoring Category 1,Scoring Category 2,Scoring Category 3,Scoring Category 4
ATM activities,,,,,,,,
ACH Debit,183,N/A,N/A,Debit,Non-fee item,Money Movement,ACH,N/A
ATM Withdrawal,200,N/A,N/A,Debit,Non-fee item,Money movement,ATM,FI owned
ATM Withdrawal foreign,200,N/A,N/A,Debit,Non-fee item,Money movement,ATM,3rd party (foreign)
External Transaction Description,External Transaction Code,Fee Item Description,Internal Fee Item Code,Credit / Debit,Scoring Category 1,Scoring Category 2,Scoring Category 3,Scoring Category 4
ATM Service Charge,299,x,1,Debit,Fee Item,All others,Money Movement,ATM
NSF,0300,x,1,Debit,Fee item,NSF /OD,N/A,N/A
POS,228,,,Debit,Non-fee item,Money movement,Debit card,POS
"""
HEADER = "ACCTNO,status,TRANCD,description,TRDATE,AMT,EFHDS1,EFHDS2,Account#,PostingDate"


def feed(path, lines):
    path.write_bytes("\n".join([HEADER, *lines]).encode("utf-8"))
    return str(path)


def now():
    return F.lit("2026-01-26 00:00:00").cast("timestamp")


def test_transactions(spark, tmp_path):
    (tmp_path / "truth.csv").write_bytes(TRUTH.encode("latin-1"))
    truth = ground_truth.transaction_truth(delimited.read_headed(spark, str(tmp_path / "truth.csv")))
    assert rows(truth, "transaction_code", "gt_L2", "gt_L4") == [
        ("0300", "NSF/OD", None), ("183", "Money movement", None), ("200", "Money movement", "3rd party (foreign)"),
        ("200", "Money movement", "FI owned"), ("228", "Money movement", "POS"), ("299", "All others", "ATM"),
    ]
    other = feed(tmp_path / "other.csv", [
        "S1,1,183,,2026-01-26,5.00,ACH Debit, PAY, PLUS,x,48,2026-01-26", "S1,1,183,,2026-01-26,5.00,ACH Debit,y,48,2026-01-26",
        "S2,1,183,,2026-01-26,5.00,ACH \x00Debit,y,48,2026-01-26", "S3,1,200,,2026-01-26,5.00,ATM Withdrawal,y,48,2026-01-26",
        "S3,1,299,,2026-01-26,3.00,ATM Service Charge,y,48,2026-01-26", "S3,1,0300,,2026-01-26,3.00,Mystery item,y,48,2026-01-26",
        "S3,1,777,,2026-01-26,3.00,Wire Transfer Fee,y,48,2026-01-26", "broken,1,2",
    ])
    pos = feed(tmp_path / "pos.csv", ["S9,1,228,POS Debit - DDA,2026-01-26,9.00,SHOP,y,48,2026-01-26"] * 5)
    raw, rejects = ragged.read_ragged(spark, other)
    cards, _ = ragged.read_ragged(spark, pos)
    assert (raw.count(), raw.filter("_repaired").count(), rejects.count()) == (7, 1, 1)
    order = raw.drop("_repaired").withColumn("rn", F.monotonically_increasing_id())
    mapping = profile.as_names(profile.map_columns(profile.profile_columns(order, "rn")))
    assert mapping == catalogs.DEFAULT_MAPPING
    catalog = catalogs.combined_transaction_catalog(
        [catalogs.transaction_catalog(raw, "NON_POS", mapping), catalogs.transaction_catalog(cards, "POS", mapping, "transaction_desc")], truth
    )
    assert [f.name for f in conform(catalog, schemas.TRANSACTION_CATALOG).schema] == schemas.TRANSACTION_CATALOG.names
    path = f"{tmp_path}/results"
    for version in ("v1", "v2"):
        results = classification.classify_transactions(catalog, version, now())
        if version == "v1":
            results = results.withColumn("category_1", F.lit("Fee item"))
        tables.save_results(results, path)
    stored = tables.load(spark, path).withColumn("layer", F.col("layer").cast("int"))
    latest = versions.of_version(stored, "v2")
    table = evaluation.evaluate(latest, truth, TRANSACTION, "transaction_code", ["gt_desc"], ["gt_desc"])
    saved = conform(table, schemas.EVALUATION_RESULTS)
    assert rows(saved, "transaction_code", "layer", "exact_match", "failure_type", "review_status") == [
        ("0300", 1, False, "WRONG BLOCK (L1)", "EVALUATED"), ("183", 1, True, None, "EVALUATED"), ("200", 2, False, "AMBIGUOUS_NO_MATCH", "EVALUATED"),
        ("228", 1, True, None, "EVALUATED"), ("299", 1, True, None, "EVALUATED"), ("777", 3, None, None, "NEEDS MANUAL REVIEW"),
    ]
    report = evaluation.kpi(table, TRANSACTION, "volume").first()
    assert (report["codes"], report["l1_weight"], report["w_exact_match"], report["target"]) == (6, 10, 0.9, "MET")
    matched = evaluation.layer_one(stored, truth, TRANSACTION, "transaction_code", ["gt_desc"], ["gt_desc"])
    compared = {r["prompt_version"]: r for r in versions.compare_versions(stored, matched, ["exact_match"], "volume").collect()}
    assert compared["v2"]["w_exact_match"] == 0.9
    assert compared["v2"]["delta_w_exact_match"] == round(0.9 - compared["v1"]["w_exact_match"], 6) > 0
    required = ["transaction_code", "layer", "category_1", "category_2", "prompt_version", "model_name", "tokens_in", "tokens_out", "estimated_cost"]
    checks = [audits.marked("category_1"), *audits.not_null(["transaction_code", "layer"]), audits.accepted_range("confidence", 0, 1)]
    assert audits.row_audits(audits.require_columns(stored, required), checks).filter("not passed").count() == 0


SHEET = """R0,still unmapped
,
Settings for levels,,,,,,
LoB,Type,Category,Sub-category,Special,Code,Name
Retail,,,,,,
,Deposits,,,,,
,,Checking (DDA),,,,
,,,,,01,Personal Checking
,,Savings,Money Market,,,
,,,,,MM,"Money
Market"
Wealth Management,,,,,,
,,Checking (DDA),,,F1,Fiduciary Ck
"""


def test_products_and_suggestions(spark, tmp_path):
    (tmp_path / "sheet.csv").write_bytes(SHEET.encode("latin-1"))
    sheet = delimited.read_positional(spark, str(tmp_path / "sheet.csv"), 7)
    truth = ground_truth.product_truth(sheet, "Deposits")
    assert rows(ground_truth.unmapped_block(sheet, ["Settings for levels"])) == [("R0", "still unmapped")]
    (tmp_path / "dep_1.csv").write_text(
        "ACCTNO,STATUS,SCCODE,AccountBranch,Account_opened_date,account_close_date\nD1,1,01,b,1/5/2024,\nD2,2,01,b,1/5/2024,2025-01-01\nD3,1,MM,b,bad,\n"
    )
    (tmp_path / "dep_2.csv").write_text(
        "ACCTNO,STATUS,SCCODE,AccountBranch,Account_opened_date,account_close_date\nD4,9,F1,b,1/5/2024,\nD5,1,ZZ,b,1/5/2024,\nD1,1,01,b,1/5/2024,\n"
    )
    (tmp_path / "types.csv").write_text(" Code , Description \n01,Personal Checking\nMM,Money Market Savings\nF1,Fiduciary Bus Int Ck\n")
    extract = delimited.read_headed(spark, f"{tmp_path}/dep_*.csv").withColumn("rn", F.monotonically_increasing_id())
    types = delimited.read_headed(spark, f"{tmp_path}/types.csv").toDF("code", "description").withColumn("rn", F.monotonically_increasing_id())
    catalog = catalogs.combined_product_catalog([catalogs.deposit_catalog(extract, types)], truth)
    full = conform(catalog, schemas.PRODUCT_CATALOG)
    results = classification.classify_products(full, "p1", now())
    valid = matching.supported_lob(truth, PRODUCT.truth[0], VALID_LOB)
    table = evaluation.evaluate(
        results.drop("product_name"), valid, PRODUCT, "product_code", ["product_name"], ["product_name"],
        exclude_missing=True,
    )
    assert [f.name for f in conform(table, schemas.PRODUCT_EVALUATION_RESULTS).schema] == schemas.PRODUCT_EVALUATION_RESULTS.names
    assert rows(table, "product_code", "canonical_match", "full_match", "failure_type", "review_status") == [
        ("01", True, True, None, "EVALUATED"), ("F1", None, None, "GT_LOB_EXCLUDED", "GT_LOB_EXCLUDED"), ("MM", True, True, None, "EVALUATED"),
        ("ZZ", None, None, None, "NEEDS MANUAL REVIEW"),
    ]
    assert evaluation.kpi(table, PRODUCT, "account_count").first()["target"] == "MET"

    history = account_history.deposit_history(extract, types, ["rn"], now())
    assert history.count() == 5
    master = tables.empty(spark, schemas.PRODUCT_MASTER)
    first = suggestions.suggest(uncategorized.uncategorized_catalog(history, master), "v2.0", now())
    assert rows(first, "PROD_core_system_mapping", "volume", "review_status") == [
        ("01", 2, "PENDING_REVIEW"), ("F1", 1, "REQUIRES_MANUAL_MAPPING"), ("MM", 1, "PENDING_REVIEW"), ("ZZ", 1, "PENDING_REVIEW"),
    ]
    assert audits.suggestion_audits(first).filter("not passed").count() == 0
    approved = first.withColumn("review_status", F.when(F.col("PROD_core_system_mapping") != "ZZ", "APPROVED").otherwise("REJECTED"))
    grown = suggestions.merge_approved(master, approved)
    left = uncategorized.uncategorized_catalog(history, grown)
    assert rows(left, "product_code") == [("ZZ",)]
