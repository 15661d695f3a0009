"""Code catalogs: one row per raw code and source."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from codeloom.functions.levels import PRODUCT, TRANSACTION
from codeloom.functions.parse import to_number
from codeloom.functions.text import UNKNOWN, strip
from codeloom.operators.frequency import code_volume, distributions_json, top_descriptions
from codeloom.operators.layers import assign_layers
from codeloom.operators.normalize import (
    DEPOSIT_INCLUDED,
    LOAN_INCLUDED,
    keep_columns,
    lookup_text,
    rename,
    with_status,
)
from codeloom.operators.ordering import first_per_key

# Canonical transaction columns, samples per code, and the client mapping used by default.
CANONICAL_COLUMNS = ("transaction_code", "description_1", "transaction_desc")
TRANSACTION_SAMPLES = 5
DEFAULT_MAPPING = {"TRANCD": "transaction_code", "EFHDS1": "description_1", "description": "transaction_desc"}


def transaction_catalog(
    feed: DataFrame, source: str, mapping: Mapping[str, str] = DEFAULT_MAPPING, text: str = "description_1",
    samples: int = TRANSACTION_SAMPLES,
) -> DataFrame:
    """Volume and most frequent descriptions per code of one feed. Only code and description columns are kept."""
    slim = keep_columns(rename(feed, mapping), CANONICAL_COLUMNS).filter(F.col("transaction_code").isNotNull())
    # Not null by construction, so no null check has to clean the code a second time.
    slim = slim.withColumn("transaction_code", F.coalesce(strip("transaction_code"), F.lit("")))
    return top_descriptions(slim, "transaction_code", text, samples).withColumn("source_file", F.lit(source))


def combined_transaction_catalog(catalogs: Sequence[DataFrame], truth: DataFrame) -> DataFrame:
    """Feeds stacked (a code of two feeds stays two rows), with layers."""
    stacked = catalogs[0]
    for other in catalogs[1:]:
        stacked = stacked.unionByName(other)
    return assign_layers(stacked, truth, "transaction_code", TRANSACTION.truth)


def deposit_catalog(extract: DataFrame, types: DataFrame) -> DataFrame:
    """Accounts per service-charge code. ``types``: code, description, rn. A null code is left out."""
    rows = with_status(extract, "STATUS", DEPOSIT_INCLUDED).select(strip("SCCODE").alias("product_code"))
    counted = code_volume(rows.filter(F.col("product_code").isNotNull()), "product_code", "account_count")
    named = lookup_text(counted, "product_code", types, "code", "description", "rn", [F.lit(UNKNOWN)], "product_name")
    return named.withColumn("source_file", F.lit("Deposit"))


def loan_accounts(extract: DataFrame, order: Sequence[Column | str]) -> DataFrame:
    """One row per account and loan type out of the monthly snapshots."""
    kept = with_status(extract, "STATUS", LOAN_INCLUDED).withColumn("type", strip("type"))
    columns = list(dict.fromkeys(["acctno", "type", "PURCOD", "PurposeDescription", "LoanTypeDesc", *[c for c in order if isinstance(c, str)]]))
    return first_per_key(kept.select(*columns), ["acctno", "type"], order)


def loan_catalog(extract: DataFrame, types: DataFrame, order: Sequence[str]) -> DataFrame:
    """Accounts, sample description and the two purpose distributions per loan type."""
    accounts = loan_accounts(extract, order)
    purpose = F.col("PurposeDescription")
    full = distributions_json(
        accounts.filter(F.col("type").isNotNull()),
        "type",
        {
            "purcod_distribution": to_number("PURCOD").cast("bigint"),
            "purpose_distribution": F.when(strip(purpose) != "", purpose),
        },
        F.col("LoanTypeDesc"),
        [*order, "acctno"],
    ).withColumnsRenamed({"rows": "account_count", "first": "sample_loan_type_desc"})
    fallbacks = [F.col("sample_loan_type_desc"), F.lit(UNKNOWN)]
    named = lookup_text(full, "type", types, "code", "description", "rn", fallbacks, "product_name")
    return named.withColumnRenamed("type", "product_code").withColumn("source_file", F.lit("Loan"))


def combined_product_catalog(catalogs: Sequence[DataFrame], truth: DataFrame) -> DataFrame:
    """Sources stacked, columns a source lacks are null, with layers. A third source (CDs) is optional."""
    stacked = catalogs[0]
    for other in catalogs[1:]:
        stacked = stacked.unionByName(other, allowMissingColumns=True)
    return assign_layers(stacked, truth, "product_code", PRODUCT.truth)
