import random

import pytest
from conftest import rows
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from codeloom.operators import hierarchy, normalize
from codeloom.operators.taxonomy import document_paths, product_paths, transaction_paths
from codeloom.plans import ground_truth
from codeloom.sources.documents import read_document

LEVELS = ["l1", "l2", "l3", "l4", "l5"]


def fold(table):
    """Sequential fill: a header sets its level and clears the deeper ones."""
    current, out = [None] * 5, []
    for sheet, rn, *cells in table:
        for i, cell in enumerate(cells):
            if cell:
                current[i] = cell
                current[i + 1:] = [None] * (4 - i)
        out.append((sheet, rn, *current))
    return out


@pytest.mark.parametrize("chunk_rows", [3, 7, 100_000])
def test_fill_equals_a_sequential_fold(spark, chunk_rows):
    rng = random.Random(chunk_rows)
    table, want = [], []
    for sheet in ("s1", "s2"):
        part = []
        for rn in range(60):
            cells = [f"{sheet}{rn}{i}" if rng.random() < 0.12 else rng.choice([None, "", " "]) for i in range(5)]
            part.append((sheet, rn, *cells))
        want += fold([(s, r, *[c.strip() if c else None for c in cs]) for s, r, *cs in part])
        table += part
    df = spark.createDataFrame(table, "sheet string, rn bigint, " + ", ".join(f"{c} string" for c in LEVELS))
    got = hierarchy.fill_levels(df.repartition(5), "sheet", "rn", LEVELS, chunk_rows=chunk_rows)
    assert rows(got, "sheet", "rn", *LEVELS) == sorted(want, key=repr)


def sheet_frame(spark, lines, sheet="f"):
    padded = [(sheet, i, *line, *[None] * (7 - len(line))) for i, line in enumerate(lines)]
    return spark.createDataFrame(padded, "sheet string, rn bigint, " + ", ".join(f"c{i} string" for i in range(7)))


LOAN_SHEET = [
    ["U1", "first unmapped"], ["U2"], [None], ["Level configuration"], [None, None], ["LoB", "Type"],
    ["Retail"], [None, None, "Mortgage\n loans"], [None, None, None, None, None, "R1", " Fixed  rate "],
    [None, None, None, "Interest Bearing", "HSA", "R2", "nan"], ["Business", None, "Real Estate", None, None, "B1", "x"],
    [None, None, None, None, None, "B2", "y"],
]


def test_product_sheet(spark):
    got = rows(ground_truth.product_truth(sheet_frame(spark, LOAN_SHEET), "Loans"))
    assert got == sorted([
        ("R1", "Fixed rate", "Retail", "Loans", "Mortgage loans", None, None, "Loans"),
        ("R2", None, "Retail", "Loans", "Mortgage loans", "Interest bearing", "HSA", "Loans"),
        ("B1", "x", "Business", "Loans", "Real Estate", None, None, "Loans"),
        ("B2", "y", "Business", "Loans", "Real Estate", None, None, "Loans"),
    ], key=repr)


def test_unmapped_block_stops_at_the_blank_row(spark):
    got = rows(ground_truth.unmapped_block(sheet_frame(spark, LOAN_SHEET), ["Level configuration"]))
    assert got == [("U1", "first unmapped"), ("U2", None)]


def test_sheet_without_heading_is_an_error(spark):
    with pytest.raises(PySparkException, match="no hierarchy heading"):
        ground_truth.product_truth(sheet_frame(spark, [["Retail"], [None, None, None, None, None, "R1"]]), "Loans").collect()


def test_transaction_truth_cleaning(spark):
    names = ["External Transaction Code", "External Transaction Description", "Scoring Category 1", "Scoring Category 2",
             "Scoring Category 3", "Scoring Category 4", "Credit / Debit"]
    data = [
        (" 0163 ", "ACH Credit", "Non-fee item", "Money Movement", "ACH", "N/A", "Credit"),
        ("299", "ATM", "Fee Item", "All others", "Money Movement", "ATM", "nan"),
        ("12", "NSF", "Fee item", "NSF /OD", "N/A", "nan", "Debit"),
        ("13", "no level", None, "Unclassified", None, None, None),
        ("", "section", "x", None, None, None, None), (None, "section", None, None, None, None, None),
        ("nan", "generic", "Fee item", None, None, None, None), ("A1", "alpha", "Fee item", None, None, None, None),
        ("External Transaction Code", "External Transaction Description", "Scoring Category 1", "Scoring Category 2", "", "", ""),
    ]
    df = spark.createDataFrame(data, ", ".join(f"`{n}` string" for n in names))
    assert rows(ground_truth.transaction_truth(df)) == sorted([
        ("0163", "ACH Credit", "Non-fee item", "Money movement", "ACH", None, "Credit"),
        ("299", "ATM", "Fee item", "All others", "Money movement", "ATM", None),
        ("12", "NSF", "Fee item", "NSF/OD", None, None, "Debit"),
        ("13", "no level", None, "Unclassified", None, None, None),
    ], key=repr)


def test_map_table_keeps_maps_to_null_apart_from_unknown(spark):
    df = spark.createDataFrame([("a",), ("b",), ("c",), (None,)], "v string")
    table = spark.createDataFrame([("a", "A"), ("b", None)], "f string, t string")
    assert rows(normalize.apply_map_table(df, "v", table, "f", "t")) == sorted([("A",), (None,), ("c",), (None,)], key=repr)


def test_last_duplicate_of_a_lookup_wins(spark):
    lookup = spark.createDataFrame([("1", "old", 1), (" 1", "new", 2), (None, "x", 3)], "k string, t string, rn int")
    df = spark.createDataFrame([("1",), ("2",)], "c string")
    got = normalize.lookup_text(df, "c", lookup, "k", "t", "rn", [F.lit("(unknown)")], "d")
    assert rows(got, "c", "d") == [("1", "new"), ("2", "(unknown)")]


def test_status_filter_and_states(spark):
    df = spark.createDataFrame([(s,) for s in ("0", "1", "2", "3.0", "9", "x", None)], "s string")
    assert rows(normalize.with_status(df, "s", normalize.DEPOSIT_INCLUDED)) == [("1",), ("3.0",), ("9",)]
    got = df.select(normalize.map_states("s", normalize.DEPOSIT_STATES)).collect()
    assert [r[0] for r in got] == ["CLOSED", "ACTIVE", "CLOSED", "DORMANT", "ACTIVE", "ACTIVE", "ACTIVE"]


def test_small_projections(spark):
    df = spark.createDataFrame([(" a ", 1, "Head"), ("b", 2, None)], "x string, n int, h string")
    assert rows(normalize.strip_strings(df), "x", "n") == [("a", 1), ("b", 2)]
    assert normalize.rename(df, {"x": "y", "absent": "z"}).columns == ["y", "n", "h"]
    assert normalize.keep_columns(df, ["h", "absent", "x"]).columns == ["h", "x"]
    assert normalize.drop_header_leaks(df, "h", "Head").count() == 1
    assert normalize.numeric_codes(spark.createDataFrame([("01",), ("1a",)], "c string"), "c").count() == 1


DOCUMENT = """# Title
## How It Works (intro)
### Level 2: not a path
## Block A — Non-fee item (Account Activity) Transactions
### Level 2: NSF/OD
### Level 2: Money movement
text
#### Level 3: Wire
**Level 4 options:** Domestic, International
#### Level 3: ATM
**Level 4 options:** 3rd party (foreign), FI owned, Sponsored (e.g., Allpoint)
## Block B — Fee item Transactions
### Level 2: All Others
#### Level 3: Money movement
##### Level 4: ACH
## Rules
### Level 2: ignored
"""


def test_document_headings_become_paths(spark, tmp_path):
    path = tmp_path / "taxonomy.md"
    path.write_text(DOCUMENT, encoding="utf-8")
    got = rows(document_paths(read_document(spark, str(path))), "l1", "l2", "l3", "l4")
    n, f = "Non-fee item", "Fee item"
    assert got == sorted([
        (n, "NSF/OD", None, None), (n, "Money movement", None, None), (n, "Money movement", "Wire", None),
        (n, "Money movement", "Wire", "Domestic"), (n, "Money movement", "Wire", "International"), (n, "Money movement", "ATM", None),
        (n, "Money movement", "ATM", "3rd party (foreign)"), (n, "Money movement", "ATM", "FI owned"), (n, "Money movement", "ATM", "Sponsored"),
        (f, "All Others", None, None), (f, "All Others", "Money movement", None), (f, "All Others", "Money movement", "ACH"),
    ], key=repr)


def test_trees_hold_each_path_once():
    for paths in (transaction_paths(), product_paths()):
        assert len(paths) == len(set(paths))
    assert ("Fee item", "All others", "Money movement", "ACH") in transaction_paths()
    assert ("Non-fee item", "Account operations", None, None) in transaction_paths()
