"""Projections and filters that turn raw extracts into canonical records."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from codeloom.functions.parse import to_status
from codeloom.functions.text import as_col, nullify, strip
from codeloom.operators.ordering import first_per_key
from codeloom.operators.skew import lookup_join

# Level spellings of the transaction truth and their canonical form.
TRANSACTION_LEVEL_MAPS: dict[str, dict[str, str | None]] = {
    "gt_L1": {"Fee Item": "Fee item", "Fee item": "Fee item", "Non-fee item": "Non-fee item"},
    "gt_L2": {
        "NSF /OD": "NSF/OD",
        "NSF/OD": "NSF/OD",
        "Money Movement": "Money movement",
        "Money movement": "Money movement",
        "Account Operations": "Account operations",
        "Account operations": "Account operations",
        "All others": "All others",
        "Service Charges": "Service Charges",
        "Interchange": "Interchange",
        "Miscellaneous": "Miscellaneous",
        "Unclassified": "Unclassified",
    },
    "gt_L3": {
        "N/A": None,
        "nan": None,
        "Money Movement": "Money movement",
        "Account Operations": "Account operations",
    },
    "gt_L4": {"N/A": None, "nan": None},
}
# Spelling of one product sub-category.
PRODUCT_LEVEL_MAPS: dict[str, dict[str, str | None]] = {
    "gt_L4_subcategory": {"Interest Bearing": "Interest bearing"}
}
# Account states of the two core-system feeds.
DEPOSIT_STATES = {
    0: "CLOSED", 1: "ACTIVE", 2: "CLOSED", 3: "DORMANT", 4: "ACTIVE",
    5: "DORMANT", 6: "DORMANT", 7: "DORMANT", 8: "CLOSED", 9: "ACTIVE",
}
LOAN_STATES = {
    1: "ACTIVE", 2: "CLOSED", 3: "DORMANT", 4: "ACTIVE",
    5: "DORMANT", 6: "DORMANT", 7: "DORMANT", 8: "CLOSED",
}
# Account states that take part in the catalogs.
DEPOSIT_INCLUDED = (1, 3, 4, 5, 6, 7, 9)
LOAN_INCLUDED = (1, 3, 4, 5, 6, 7)


def strip_strings(df: DataFrame) -> DataFrame:
    """Strip every string cell in one projection."""
    kinds = dict(df.dtypes)
    return df.select(*[strip(F.col(f"`{c}`")).alias(c) if kinds[c] == "string" else F.col(f"`{c}`") for c in df.columns])


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed({k: v for k, v in mapping.items() if k in df.columns})


def keep_columns(df: DataFrame, wanted: Iterable[str]) -> DataFrame:
    """Whitelisted columns that exist; done right after reading, nothing else travels on."""
    return df.select(*[F.col(f"`{c}`") for c in wanted if c in df.columns])


def apply_map(value: Column | str, mapping: Mapping[str, str | None]) -> Column:
    """Mapped value when the key is known, even when it maps to null; otherwise the value itself."""
    col = as_col(value)
    out = col
    for source, target in mapping.items():
        out = F.when(col == source, F.lit(target).cast("string")).otherwise(out)
    return out


def apply_maps(df: DataFrame, maps: Mapping[str, Mapping[str, str | None]]) -> DataFrame:
    return df.withColumns({c: apply_map(c, m) for c, m in maps.items() if c in df.columns})


def apply_map_table(df: DataFrame, column: str, table: DataFrame, source: str, target: str) -> DataFrame:
    """Same rule with a mapping held in a table; the key flag keeps "maps to null" apart from "unknown".

    The planner broadcasts the table when its size allows it; beyond that, rows of a frequent value are dealt to many tasks.
    """
    side = table.groupBy(F.col(source).alias(column)).agg(F.max(target).alias("_to"), F.lit(True).alias("_known"))
    joined = lookup_join(df, side, column)
    value = F.when(F.col("_known"), F.col("_to")).otherwise(F.col(column))
    return joined.withColumn(column, value).select(*df.columns)


def map_states(value: Column | str, states: Mapping[int, str]) -> Column:
    """Numeric status to ACTIVE / DORMANT / CLOSED; everything unknown counts as ACTIVE."""
    status = to_status(value)
    out = F.lit("ACTIVE")
    for number, state in states.items():
        out = F.when(status == number, F.lit(state)).otherwise(out)
    return out


def with_status(df: DataFrame, column: str, included: Sequence[int]) -> DataFrame:
    """Keep the included states; a status that is not a number is excluded."""
    return df.filter(F.coalesce(to_status(column).isin(*included), F.lit(False)))


def drop_blank_codes(df: DataFrame, code: str) -> DataFrame:
    text = strip(code)
    return df.filter(text.isNotNull() & ~text.isin("", "nan"))


def drop_header_leaks(df: DataFrame, column: str, header: str) -> DataFrame:
    """Drop header rows repeated inside the data; null cells stay."""
    return df.filter(~strip(column).eqNullSafe(F.lit(header)))


def numeric_codes(df: DataFrame, code: str) -> DataFrame:
    return df.filter(F.col(code).rlike(r"^\d+$"))


def last_per_key(lookup: DataFrame, key: str, text: str, order: str) -> DataFrame:
    """Dimension with one row per stripped key: the last row wins, as when a dictionary is filled."""
    rows = lookup.select(strip(key).alias("_key"), strip(text).alias("_text"), F.col(order).alias("_order"))
    return first_per_key(rows.filter(F.col("_key").isNotNull()), ["_key"], [F.desc("_order"), F.asc("_text")])


def lookup_text(
    df: DataFrame, code: str, lookup: DataFrame, key: str, text: str, order: str, fallbacks: Sequence[Column], out: str
) -> DataFrame:
    """Lookup description with a fallback chain. Rows of a frequent code do not meet in one task."""
    side = last_per_key(lookup, key, text, order).select(F.col("_key").alias(code), "_text")
    joined = lookup_join(df, side, code)
    return joined.withColumn(out, F.coalesce(F.col("_text"), *fallbacks)).select(*[c for c in df.columns if c != out], out)


def clean_artifacts(df: DataFrame, columns: Iterable[str], tokens: Iterable[str] = ("None", "nan")) -> DataFrame:
    tokens = tuple(tokens)
    return df.withColumns({c: nullify(c, tokens) for c in columns})


def conform(df: DataFrame, schema) -> DataFrame:
    """Project onto a declared schema; absent columns become typed nulls."""
    return df.select(
        *[
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )
