"""Hand-made mappings as flat, normalized tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codeloom.functions.text import nullify, squeeze, strip
from codeloom.operators.hierarchy import before_sentinel, fill_levels, first_filled
from codeloom.operators.normalize import (
    PRODUCT_LEVEL_MAPS,
    TRANSACTION_LEVEL_MAPS,
    apply_maps,
    clean_artifacts,
    drop_blank_codes,
    drop_header_leaks,
    numeric_codes,
    rename,
    strip_strings,
)

# Columns of the transaction sheet and their canonical names.
TRANSACTION_COLUMNS = {
    "External Transaction Code": "transaction_code",
    "External Transaction Description": "gt_desc",
    "Scoring Category 1": "gt_L1",
    "Scoring Category 2": "gt_L2",
    "Scoring Category 3": "gt_L3",
    "Scoring Category 4": "gt_L4",
    "Credit / Debit": "gt_credit_debit",
}
TRANSACTION_ORDER = ("transaction_code", "gt_desc", "gt_L1", "gt_L2", "gt_L3", "gt_L4", "gt_credit_debit")
# Column positions of the product sheets, and the cell above the hierarchy.
PRODUCT_LEVELS = (
    "gt_L1_line_of_business", "gt_L2_type", "gt_L3_category", "gt_L4_subcategory", "gt_L5_special",
)
HIERARCHY_HEADING = "LoB"


def transaction_truth(sheet: DataFrame) -> DataFrame:
    """Cleaned truth: section rows, blank codes, repeated headers and non-numeric codes are dropped,
    level spellings unified. A row without a first level stays: its code is known, its path empty."""
    code, level1 = "External Transaction Code", "Scoring Category 1"
    rows = numeric_codes(drop_header_leaks(drop_blank_codes(strip_strings(sheet), code), level1, level1), code)
    named = rename(rows, TRANSACTION_COLUMNS).select(*TRANSACTION_ORDER)
    return clean_artifacts(apply_maps(named, TRANSACTION_LEVEL_MAPS), TRANSACTION_ORDER)


def product_truth(sheet: DataFrame, domain: str) -> DataFrame:
    """Flat truth out of a headerless sheet (sheet, rn, c0..c6) whose level headers apply downwards."""
    cells = [f"c{i}" for i in range(7)]
    trimmed = sheet.select(
        "sheet", "rn", *[F.nullif(strip(c), F.lit("")).alias(c) for c in cells],
        (first_filled(cells) == HIERARCHY_HEADING).alias("_heading"),
    )
    named = trimmed.withColumnsRenamed(dict(zip(cells, (*PRODUCT_LEVELS, "product_code", "product_name"))))
    filled = fill_levels(named, "sheet", "rn", PRODUCT_LEVELS, start=F.col("_heading"))
    rows = filled.filter(F.col("product_code").isNotNull())
    rows = rows.withColumn("gt_L2_type", F.coalesce("gt_L2_type", F.lit(domain)))
    texts = ["product_code", "product_name", *PRODUCT_LEVELS]
    return apply_maps(
        rows.select(*[nullify(squeeze(c)).alias(c) for c in texts], F.lit(domain).alias("product_domain")),
        PRODUCT_LEVEL_MAPS,
    )


def unmapped_block(sheet: DataFrame, stop_headings: Sequence[str] = ()) -> DataFrame:
    """Codes listed above the hierarchy: everything up to the first blank or known heading."""
    first = strip("c0")
    stop = first.isNull() | (first == "") | first.isin(*stop_headings, HIERARCHY_HEADING)
    return before_sentinel(sheet, "sheet", "rn", stop).select(
        first.alias("product_code"), F.nullif(strip("c1"), F.lit("")).alias("product_name")
    )
