"""The legal level paths, validity of predictions, and taxonomy documents as tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from codeloom.functions.text import canon, squeeze, strip
from codeloom.operators.hierarchy import fill_levels
from codeloom.operators.rules import UNCLASSIFIED

# The transaction tree. Level 2 -> level 3 -> level 4 options (level 4 is always optional).
NON_FEE_TREE: dict[str, dict[str, tuple[str, ...]]] = {
    "NSF/OD": {},
    "Money movement": {
        "ACH": ("Direct Deposit",),
        "ATM": ("3rd party (foreign)", "FI owned", "Sponsored"),
        "Check": (),
        "Transfers & Payments": (),
        "Deposits": (),
        "Withdrawals": (),
        "Wire": ("Domestic", "International"),
        "Debit Card": ("POS",),
        "Credit Card": ("POS",),
    },
    "Account operations": {
        "Closing": (),
        "Fraud & Stop Payment": (),
        "Memo Posting": (),
        "Interest": (),
        "Govt. & Tax": (),
        "Integration": (),
        "Operational": (),
    },
    "Misc": {},
    "Unclassified": {},
}
FEE_TREE: dict[str, dict[str, tuple[str, ...]]] = {
    "NSF/OD": {},
    "All others": {
        "Money movement": ("ACH", "ATM", "Wire", "Transfers & Payments"),
        "Account operations": ("Misc",),
    },
    "Service Charges": {},
    "Interchange": {},
    "Unclassified": {},
}
# The canonical product tree. Line of business -> type -> categories.
PRODUCT_TREE: dict[str, dict[str, tuple[str, ...]]] = {
    "Retail": {
        "Deposits": ("Checking (DDA)", "Savings", "Certificates of deposit (CDs)"),
        "Loans": (
            "Mortgage loans", "HELOCs (Home equity lines of credit)", "Credit card", "Personal loans", "Auto loans",
            "Student loans",
        ),
        "Services": (
            "Online Banking", "Mobile Banking", "Bill Pay", "Overdraft", "Mobile Deposits",
            "Person-to-Person Payments (P2P)", "Debit Cards", "Safe Deposit Boxes",
        ),
    },
    "Business": {
        "Deposits": ("Checking (DDA)", "Savings", "Certificates of deposit (CDs)"),
        "Loans": ("Real Estate", "Receivables-Based", "Line of Credit", "Equipment Financing", "Credit Card"),
        "Cash Management Services": (
            "Online Banking", "Mobile Banking", "ACH", "Wire (Domestic)", "SWIFT Wires (International)", "Overdraft",
            "Remote Deposit Capture", "Debit Cards", "Positive Pay", "Account Reconciliation",
            "Target Balance Accounts", "Sweeps", "Controlled Disbursement Accounts", "Payroll", "Collections",
            "Lockbox", "Armored Car", "Cash Vault", "Merchant Services", "Transaction Monitoring",
            "Foreign Currency Exchange (FX)",
        ),
    },
    "Wealth Management": {"Securities": ("Transaction", "Loans")},
}


def transaction_paths() -> list[tuple[str | None, ...]]:
    """Every legal (L1, L2, L3, L4); a path may stop at any level, and CDs stop at account operations."""
    paths: list[tuple[str | None, ...]] = []
    for block, tree in (("Non-fee item", NON_FEE_TREE), ("Fee item", FEE_TREE)):
        for level2, children in tree.items():
            paths.append((block, level2, None, None))
            for level3, details in children.items():
                paths.append((block, level2, level3, None))
                paths.extend((block, level2, level3, level4) for level4 in details)
    return paths


def product_paths() -> list[tuple[str | None, ...]]:
    """Every canonical (L1, L2, L3); deeper levels belong to the institution."""
    paths: list[tuple[str | None, ...]] = []
    for lob, types in PRODUCT_TREE.items():
        for kind, categories in types.items():
            paths.extend((lob, kind, category) for category in (*categories, UNCLASSIFIED))
    return paths


def paths_table(spark: SparkSession, paths: Sequence[tuple[str | None, ...]]) -> DataFrame:
    depth = len(paths[0])
    return spark.createDataFrame(list(paths), ", ".join(f"l{i + 1} string" for i in range(depth)))


def path_key(levels: Sequence[Column | str]) -> Column:
    return F.concat_ws("\x1f", *[canon(c) for c in levels])


def illegal_predictions(pred: DataFrame, levels: Sequence[str], paths: Sequence[tuple[str | None, ...]]) -> DataFrame:
    """Predictions whose path is not in the tree. The tree is a code constant, so its broadcast is bounded."""
    legal = paths_table(pred.sparkSession, paths)
    keyed = legal.select(path_key(legal.columns).alias("_path")).distinct()
    return (
        pred.withColumn("_path", path_key(levels)).join(F.broadcast(keyed), "_path", "left_anti").drop("_path")
    )


def document_paths(lines: DataFrame, rn: str = "rn", text: str = "value", sheet: str = "sheet") -> DataFrame:
    """Level paths stated by the headings of a taxonomy document.

    ``## Block X — Name`` opens a level-1 block, ``### Level 2: Name`` and deeper headings open the
    levels below it, and a ``**Level 4 options:** a, b`` line lists alternatives for level 4. The same
    fill as for sheets gives each heading its path.
    """
    value = F.col(text)
    block = F.nullif(F.regexp_extract(value, r"^## Block [A-Z] . ([^(]+?)(?: \(.*)?(?: Transactions)?\s*$", 1), F.lit(""))
    cells = {"l1": block}
    for depth in (2, 3, 4):
        cells[f"l{depth}"] = F.nullif(
            squeeze(F.regexp_extract(value, rf"^#+ Level {depth}: (.+)$", 1)), F.lit("")
        )
    options = F.regexp_extract(value, r"^\*\*Level 4 options:\*\* (.+)$", 1)
    # Parentheses may hold commas, so only commas outside them separate options.
    listed = F.when(options != "", F.split(options, r",\s*(?![^()]*\))"))
    # A new section that is no block closes the block before it.
    closes = value.rlike(r"^## ") & block.isNull()
    cells["l1"] = F.when(closes, F.lit("-")).otherwise(block)
    sheet_rows = lines.select(
        sheet, rn, *[c.alias(n) for n, c in cells.items()],
        F.coalesce(*cells.values()).isNotNull().alias("_heading"), listed.alias("_options"),
    )
    filled = fill_levels(sheet_rows, sheet, rn, list(cells))
    usable = filled.filter((F.col("l1") != "-") & F.col("l2").isNotNull() & (F.col("_heading") | F.col("_options").isNotNull()))
    bare = F.regexp_replace(F.col("_option"), r"\s*\((e\.g\.|if ).*\)$", "")
    opened = usable.withColumn("_option", F.explode_outer("_options"))
    return opened.select(
        sheet, "l1", "l2", "l3", F.coalesce(strip(bare), F.col("l4")).alias("l4")
    ).distinct()
