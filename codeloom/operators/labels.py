"""Flat labels and attributes read from a text by fixed vocabularies."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from codeloom.functions.text import as_col
from codeloom.operators.rules import word

# The two label sets; the order of labels settles ties. Words and phrases are separated by bars.
BLOCK_LABELS = {
    "Non-fee item": "withdrawal|deposit|debit|credit|transfer|payment|check|purchase",
    "Fee item": "fee|fees|charge|charges|surcharge|penalty",
}
CATEGORY_LABELS = {
    "Money movement": "ach|atm|wire|transfer|deposit|withdrawal|pos|payment|check|zelle",
    "Account operations": "closing|memo|interest|stop payment|withholding|levy|inquiry|fraud|hold",
    "NSF/OD": "nsf|od|overdraft|insufficient|returned",
    "Misc": "sweep|cash management|investment|edi|zba|syndication|trust",
    "Service Charges": "service charge|maintenance|annual fee|monthly",
    "Interchange": "interchange",
}
# Transaction methods, first match wins.
METHODS = {
    "ACH": word("ach|direct deposit"),
    "ATM": word("atm|itm"),
    "Wire": word("wire|swift"),
    "Debit Card": word("pos|debit card|point of sale"),
    "Credit Card": word("credit card"),
    "Check": word("check|checks"),
    "Transfer": word("transfer|zelle|epay|p2p"),
    "Deposit": word("deposit|deposits"),
    "Withdrawal": word("withdrawal|withdrawals"),
}
REVERSAL = word("reversal|reversals|reverse|reversed|chargeback")
FEE = word("fee|fees|charge|charges|surcharge|penalty")
REFUND = word("refund|refunds|rebate|reimbursement")


def flat_label(value: Column | str, labels: Mapping[str, str]) -> Column:
    """Label with the most hits of its words and phrases, earlier labels first among equals; null when nothing hits.

    The text is cut into words of letters and digits once; phrases are looked for between separators that a neighbouring hit may share.
    """
    text = F.lower(F.coalesce(as_col(value), F.lit("")))
    terms = {name: listed.split("|") for name, listed in labels.items()}
    single = {name: [t for t in own if t.isalnum()] for name, own in terms.items()}
    known = sorted({t for own in single.values() for t in own})
    # Written down once and used by every label below.
    found = F.filter(F.split(text, "[^a-z0-9]+"), lambda t: t.isin(*known))

    def count(name: str, hits: Column) -> Column:
        phrases = "|".join(t for t in terms[name] if not t.isalnum())
        n = F.size(F.filter(hits, lambda t: t.isin(*single[name])))
        return n + F.regexp_count(text, F.lit(f"(?<![a-z0-9])({phrases})(?![a-z0-9])")) if phrases else n

    def best(hits: Column) -> Column:
        scored = F.array(*[
            F.struct(count(name, hits).alias("n"), F.lit(-i).alias("o"), F.lit(name).alias("label")) for i, name in enumerate(labels)
        ])
        return F.array_max(F.filter(scored, lambda s: s["n"] > 0))["label"]

    return F.transform(F.array(found), best)[0]


def attributes(value: Column | str) -> dict[str, Column]:
    """Transaction method and the reversal, fee and refund flags."""
    text = F.lower(F.coalesce(as_col(value), F.lit("")))
    method = F.lit(None).cast("string")
    for name, pattern in reversed(METHODS.items()):
        method = F.when(text.rlike(pattern), F.lit(name)).otherwise(method)
    return {
        "transaction_method": method,
        "is_reversal": text.rlike(REVERSAL),
        "is_fee": text.rlike(FEE),
        "is_refund": text.rlike(REFUND),
    }
