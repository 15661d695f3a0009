"""Account history out of the deposit and loan extracts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from codeloom import schemas
from codeloom.functions.parse import to_date_mixed, to_number
from codeloom.functions.text import UNKNOWN, nullify, strip
from codeloom.operators.normalize import DEPOSIT_STATES, LOAN_STATES, conform, lookup_text, map_states
from codeloom.operators.ordering import cap_per_key, first_per_key

# What the seed keeps of a code where a sample is asked for.
ROWS_PER_CODE = 50


def _optional(df: DataFrame, name: str) -> Column:
    return F.col(f"`{name}`") if name in df.columns else F.lit(None).cast("string")


def deposit_history(extract: DataFrame, types: DataFrame, order: Sequence[Column | str], as_of: Column) -> DataFrame:
    """First row per account; the description comes from the type list."""
    rows = extract.withColumns({"ACCTNO": strip("ACCTNO"), "SCCODE": strip("SCCODE")})
    rows = first_per_key(rows, ["ACCTNO"], order)
    named = lookup_text(rows, "SCCODE", types, "code", "description", "rn", [F.lit(UNKNOWN)], "_description")
    shaped = named.select(
        F.col("ACCTNO").alias("AccountIdentifier"),
        F.col("SCCODE").alias("ProductInstanceReference"),
        F.col("_description").alias("ProductInstanceDescription"),
        strip(_optional(extract, "AccountBranch")).alias("BranchLocationReference"),
        to_date_mixed("Account_opened_date").alias("AccountOpeningDate"),
        to_date_mixed(_optional(extract, "account_close_date")).alias("AccountClosingDate"),
        map_states("STATUS", DEPOSIT_STATES).alias("AccountStatus"),
        as_of.alias("effective_ts"),
    )
    return conform(shaped, schemas.ACCOUNT_HISTORY)


def loan_history(extract: DataFrame, types: DataFrame, order: Sequence[Column | str], as_of: Column) -> DataFrame:
    """First row per account and type; the raw description comes before the type list."""
    rows = extract.withColumns({"acctno": strip("acctno"), "type": strip("type")})
    rows = first_per_key(rows, ["acctno", "type"], order)
    own = nullify(strip("LoanTypeDesc"), ("", "nan", "None"))
    named = lookup_text(rows, "type", types, "code", "description", "rn", [F.lit(UNKNOWN)], "_listed")
    shaped = named.select(
        F.col("acctno").alias("AccountIdentifier"),
        F.col("type").alias("ProductInstanceReference"),
        F.coalesce(own, F.col("_listed")).alias("ProductInstanceDescription"),
        strip(_optional(extract, "Branch")).alias("BranchLocationReference"),
        to_date_mixed(_optional(extract, "DATOPN")).alias("AccountOpeningDate"),
        map_states("STATUS", LOAN_STATES).alias("AccountStatus"),
        to_number(_optional(extract, "RATE"), "decimal(8,5)").alias("InterestRate"),
        as_of.alias("effective_ts"),
    )
    return conform(shaped, schemas.ACCOUNT_HISTORY)


def account_history(deposits: DataFrame, loans: DataFrame, rows_per_code: int | None = None) -> DataFrame:
    """Both feeds; with ``rows_per_code``, a sample of so many rows of each product code (the sampling step of the seed)."""
    stacked = deposits.unionByName(loans)
    if rows_per_code is None:
        return stacked
    order = ["AccountIdentifier", "ProductInstanceDescription", "AccountStatus"]
    return cap_per_key(stacked, ["ProductInstanceReference"], order, rows_per_code)
