"""Line of business out of purpose codes, customer classes and account context."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codeloom.functions.text import strip
from codeloom.operators.rules import customer_class_lob, purpose_lob
from codeloom.operators.skew import lookup_join


def with_purpose_lob(df: DataFrame, purpose: str, out: str = "purpose_lob") -> DataFrame:
    return df.withColumn(out, purpose_lob(purpose))


def transactions_with_account_type(
    transactions: DataFrame, accounts: DataFrame, account: str, internal: str, kind: str, columns: Sequence[str] | None = None
) -> DataFrame:
    """Bring the account type to each transaction; busy accounts are dealt to many tasks. ``columns``: what is kept of a transaction."""
    side = accounts.groupBy(strip(internal).alias("_account")).agg(F.min(kind).alias(kind))
    return lookup_join(transactions, side, "_account", value=strip(account), columns=columns)


def accounts_with_customer_class(
    accounts: DataFrame, relationships: DataFrame, customers: DataFrame, columns: Sequence[str] | None = None
) -> DataFrame:
    """Customer class and its line of business of the primary owner of each account.

    ``relationships``: CIF, Relationship, AccountNumber; ``customers``: CIF, CFCLAS. Customers that own
    very many accounts do not make their accounts meet in one task. ``columns``: what is kept of an account and its owner (all
    columns of the account and CIF by default).
    """
    primary = relationships.filter(F.col("Relationship") == "Primary")
    owner = primary.groupBy("AccountNumber").agg(F.min("CIF").alias("CIF"))
    classes = customers.groupBy("CIF").agg(F.min("CFCLAS").alias("CFCLAS"))
    kept = None if columns is None else [c for c in columns if c in accounts.columns]
    owned = lookup_join(accounts, owner, "AccountNumber", columns=kept)
    return lookup_join(owned, classes, "CIF", columns=columns).withColumn("class_lob", customer_class_lob("CFCLAS"))
