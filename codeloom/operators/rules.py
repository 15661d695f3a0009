"""Rule tables that place a description in the taxonomy.

A rule is (pattern, veto, path, confidence): the first rule whose pattern is found and whose veto is
not decides. Patterns run on lower-cased text and avoid word-boundary escapes, so the same text
works in Spark, in Python and in other SQL engines.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from codeloom.functions.text import as_col


@dataclass(frozen=True)
class Rule:
    pattern: str
    path: tuple[str | None, ...]
    veto: str | None = None
    confidence: float = 0.9


def word(pattern: str) -> str:
    """The pattern as whole words."""
    return f"(^|[^a-z0-9])({pattern})([^a-z0-9]|$)"


# Fixed values up to the rule tables below: names of levels, and the words and patterns that lead to them.
NON_FEE, FEE = "Non-fee item", "Fee item"
MOVE, OPS, NSF, MISC = "Money movement", "Account operations", "NSF/OD", "Misc"
OTHERS, SERVICE, INTERCHANGE, UNCLASSIFIED = "All others", "Service Charges", "Interchange", "Unclassified"

FEE_WORDS = word("fee|fees|charge|charges|surcharge|penalty|commission")
NSF_WORDS = word(
    "nsf|nsf/od|od|overdraft|insufficient funds|non-sufficient funds|uncollected funds|bounced|"
    "return item|returned item|return check|returned check"
)


def _non_fee(level2: str, level3: str | None = None, level4: str | None = None) -> tuple[str | None, ...]:
    return (NON_FEE, level2, level3, level4)


def _fee(level2: str, level3: str | None = None, level4: str | None = None) -> tuple[str | None, ...]:
    return (FEE, level2, level3, level4)


# Money given back for a fee is a deposit; this is asked before the fee rules.
FEE_REFUND_RULES = (Rule(word("refund|refunds|reversal|reversals|reverse|reimbursement"), _non_fee(MOVE, "Deposits")),)

FEE_RULES = (
    Rule(word("interchange"), _fee(INTERCHANGE)),
    Rule(word("sales tax|transit fee|sweep transaction|analysis|non-qualification"), _fee(OTHERS, OPS, MISC), confidence=0.8),
    Rule(NSF_WORDS, _fee(NSF), veto=word("daily uncollected balance")),
    Rule(word("atm|surcharge|balance inquiry"), _fee(OTHERS, MOVE, "ATM")),
    Rule(word("ach"), _fee(OTHERS, MOVE, "ACH"), veto=word("block")),
    Rule(word("wire|wires"), _fee(OTHERS, MOVE, "Wire")),
    Rule(word("fx|currency|foreign exchange|voice response|redeposit|telephone transfer|transfer"),
         _fee(OTHERS, MOVE, "Transfers & Payments")),
    Rule(word("service charge|service charges|service fee|annual fee|annual account fee|box rental|"
              "annual rental|monthly service|minimum fee|admin fee|s/c|maintenance fee|fee waiver|fee in service charge"), _fee(SERVICE)),
    Rule(word("chargeback|chargebacks|stop payment|check image|check order|close account|collection item|counter check|"
              "credit back|dormant|escheated|excess|fax|image|bill pay|alert|lost|debit card|statement|statements|"
              "research|safe deposit|mail|bad address|notary|hb transaction|reconciliation|ach block|uncollected balance|"
              "positive pay|verification|trading|brokerage|custody"), _fee(OTHERS, OPS, MISC)),
)

NON_FEE_RULES = (
    Rule(word("memo|pre-auth|preauth"), _non_fee(OPS, "Memo Posting"), veto=word("pos|recurring")),
    Rule(word("cd|cds|certificate|certificates"), _non_fee(OPS), veto=word("transfer|xfer"), confidence=0.8),
    Rule(word("ach block|edi|electronic data interchange|zba|rdc|syndication|accounts payable|cash management|"
              "mutual fund|investment|dealer|lease|stockholder|trust|trade|trade-related|account reconciliation|"
              "business mobile deposit|arp|pos pay|batch|file upload|sweeps"), _non_fee(MISC),
         veto=word("insured cash")),
    Rule(word("insured cash|ics|int to bal"), _non_fee(OPS, "Integration")),
    Rule(word("nsf|odp|overdraft|od balance|returned deposited|returned cashed|return item"), _non_fee(NSF)),
    Rule(word("withholding|garnishment|levy|federal interest withheld|state interest withheld|"
              "federal/state interest withheld"), _non_fee(OPS, "Govt. & Tax")),
    Rule(word("closing|death distribution"), _non_fee(OPS, "Closing")),
    Rule(word("stop payment|fraud|hold placement"), _non_fee(OPS, "Fraud & Stop Payment")),
    Rule(word("chargeback|chargebacks"), _non_fee(OPS, "Fraud & Stop Payment"), veto=word("ach")),
    Rule(word("int bnking|internet banking"), _non_fee(OPS, "Integration"), veto=word("wire")),
    Rule(word("foreign wire|international wire|swift"), _non_fee(MOVE, "Wire", "International")),
    Rule(word("domestic wire"), _non_fee(MOVE, "Wire", "Domestic")),
    Rule(word("wire|wires"), _non_fee(MOVE, "Wire")),
    Rule(word("interest|accrued|cash back"), _non_fee(OPS, "Interest"), veto=word("rental")),
    Rule(word("encoding error|correction|accrual adjustment|do not use|quick statement|credit back item|"
              "contract collection reversal"), _non_fee(OPS, "Operational"), veto=word("ach")),
    Rule(word("credit card payment|credit line payment"), _non_fee(MOVE, "Transfers & Payments")),
    Rule(word("credit card"), _non_fee(MOVE, "Credit Card", "POS")),
    Rule(word("pos|point of sale|debit card"), _non_fee(MOVE, "Debit Card", "POS")),
    Rule(word("direct deposit|payroll deposit"), _non_fee(MOVE, "ACH", "Direct Deposit")),
    Rule(word("ach"), _non_fee(MOVE, "ACH")),
    Rule(word("allpoint"), _non_fee(MOVE, "ATM", "Sponsored")),
    Rule(word("foreign atm|3rd party atm"), _non_fee(MOVE, "ATM", "3rd party (foreign)")),
    Rule(word("atm|itm|itm-atm"), _non_fee(MOVE, "ATM")),
    Rule(word("hsa distribution|hsa transfer|hsa direct transfer"), _non_fee(MOVE, "Withdrawals")),
    Rule(word("check deposit|check|checks"), _non_fee(MOVE, "Check"), veto=word("checking|interest")),
    Rule(word("transfer|transfers|xfer|zelle|epay|telephone|voice response|loan payment|bill pay|p2p|aft|"
              "fresh start|rental payment|protection payment|payment"), _non_fee(MOVE, "Transfers & Payments")),
    Rule(word("contribution|account funding|pod credit|dividend|disbursement|deposit|deposits|deposited"),
         _non_fee(MOVE, "Deposits")),
    Rule(word("withdrawal|withdrawals|eft|force pay debit|cash advance|pod bank|single item debit|"
              "single automated debit"), _non_fee(MOVE, "Withdrawals")),
)

SCORED_LEVEL2 = (NSF, MOVE)
CREDIT_WORDS = word(
    "credit|deposit|deposits|deposited|refund|refunds|reimbursement|contribution|dividend|disbursement|"
    "transfer from|incoming|interest earned|interest deposit"
)
DEBIT_WORDS = word("debit|withdrawal|withdrawals|outgoing|credit card|transfer to")

UNPLACED = 0.3


def _found(text: Column, pattern: str) -> Column:
    return text.rlike(pattern)


# The fee block is decided first; each block then has its own rules.
FEE_BLOCK = (*FEE_REFUND_RULES, *FEE_RULES)


def fires(text: Column, rule: Rule) -> Column:
    condition = _found(text, rule.pattern)
    return condition & ~_found(text, rule.veto) if rule.veto else condition


def fires_sql(text: str, rule: Rule) -> str:
    found = f"{text} RLIKE '{rule.pattern}'"
    return f"{found} AND NOT {text} RLIKE '{rule.veto}'" if rule.veto else found


def transaction_placement(description: str) -> Column:
    """Struct (category_1..4, confidence) of a description, given as a column name or SQL expression.

    Written as one CASE text: some forty rules would otherwise be several hundred Column calls.
    """
    text = f"lower(coalesce({description}, ''))"

    def place(path: Sequence[str | None], confidence: float) -> str:
        cells = ", ".join(f"'category_{i + 1}', CAST({'NULL' if v is None else repr(v)} AS STRING)" for i, v in enumerate(path))
        return f"named_struct({cells}, 'confidence', {confidence}D)"

    def block(rules: Sequence[Rule], otherwise: tuple[str | None, ...]) -> str:
        whens = " ".join(f"WHEN {fires_sql(text, r)} THEN {place(r.path, r.confidence)}" for r in rules)
        return f"CASE {whens} ELSE {place(otherwise, UNPLACED)} END"

    fee, plain = block(FEE_BLOCK, _fee(UNCLASSIFIED)), block(NON_FEE_RULES, _non_fee(UNCLASSIFIED))
    return F.expr(f"CASE WHEN {text} RLIKE '{FEE_WORDS}' THEN {fee} ELSE {plain} END")


def include_in_scoring(category_1: Column | str, category_2: Column | str) -> Column:
    """Only account activity that moves money or overdraws counts; fees never do."""
    return F.coalesce((as_col(category_1) == NON_FEE) & as_col(category_2).isin(*SCORED_LEVEL2), F.lit(False))


def direction(description: Column | str) -> Column:
    """Credit when the text says so and does not also say debit; Debit when unclear."""
    text = F.lower(F.coalesce(as_col(description), F.lit("")))
    return F.when(_found(text, CREDIT_WORDS) & ~_found(text, DEBIT_WORDS), F.lit("Credit")).otherwise(F.lit("Debit"))


# --- products ---------------------------------------------------------------------------------------------

BUSINESS_WORDS = word(
    "business|bus|commercial|comm|corporate|corp|municipal|agricultural|agriculture|ag|agri|farm|cre|"
    "public funds|non-profit|analysis|analyzed|equipment|receivables|treasury"
)
RETAIL_WORDS = word("personal|consumer|individual|residential|student|auto|home equity|heloc|hsa|utma|ugma|christmas|vacation|holiday")
FIDUCIARY_WORDS = word("fiduciary|trust|utma|ugma|ira|estate")
REAL_ESTATE = word("real estate")

# Purpose code and customer class to line of business; others depend on context.
PURPOSE_LOB = {
    "1": "Retail", "2": "Retail", "3": "Business", "4": "Business", "5": "Business", "6": "Business", "9": "Business",
}
CUSTOMER_CLASS_LOB = {
    "I": "Retail", "B": "Business", "C": "Business", "P": "Business",
    "T": "Wealth Management", "E": "Wealth Management", "F": "Wealth Management",
}

# (domain, line of business or None for any, rule); path = (product_category,)
PRODUCT_CATEGORY_RULES: tuple[tuple[str, str | None, Rule], ...] = (
    ("Deposits", None, Rule(word("certificate|certificates|cd|cds"), ("Certificates of deposit (CDs)",))),
    ("Deposits", None, Rule(word("club"), ("Checking (DDA)",), confidence=0.85)),
    ("Deposits", None, Rule(word("savings|saving|sav|money market|mm|mmda|hsa|health"), ("Savings",))),
    ("Deposits", None, Rule(word("checking|ck|chk|dda|now|demand"), ("Checking (DDA)",))),
    ("Loans", "Retail", Rule(word("heloc|home equity line|home equity|sheloc"), ("HELOCs (Home equity lines of credit)",))),
    ("Loans", "Retail", Rule(word("overdraft|odp"), ("Personal loans",))),
    ("Loans", "Retail", Rule(word("credit card"), ("Credit card",))),
    ("Loans", "Retail", Rule(word("student"), ("Student loans",))),
    ("Loans", "Retail", Rule(word("auto|vehicle|car"), ("Auto loans",))),
    ("Loans", "Retail", Rule(word("mortgage|residential|re|real estate"), ("Mortgage loans",))),
    ("Loans", "Retail", Rule(word("personal|consumer|unsecured|installment"), ("Personal loans",))),
    ("Loans", "Business", Rule(word("credit card"), ("Credit Card",))),
    ("Loans", "Business", Rule(word("cre|re|real estate|mortgage"), ("Real Estate",))),
    ("Loans", "Business", Rule(word("equipment"), ("Equipment Financing",))),
    ("Loans", "Business", Rule(word("receivables|receivables-based|inventory"), ("Receivables-Based",))),
    ("Loans", "Business", Rule(word("line|line of credit|loc|agricultural|agriculture|ag|farm|commercial|business"),
                               ("Line of Credit",), confidence=0.8)),
)
SPECIAL_RULES = (
    Rule(word("hsa|health savings"), ("HSA",)),
    Rule(word("utma"), ("UTMA",)),
    Rule(word("ugma"), ("UGMA",)),
    Rule(word("club"), ("Club",)),
    Rule(word("arm|adjustable"), ("ARM",)),
    Rule(word("fixed"), ("Fixed",)),
)
SUBCATEGORY_RULES = (
    Rule(word("money market|mm|mmda"), ("Money Market",)),
    Rule(word("premium"), ("Premium",)),
    Rule(word("basic"), ("Basic",)),
    Rule(word("jumbo"), ("Jumbo",)),
    Rule(word("interest|int"), ("Interest bearing",)),
    Rule(word("agricultural|agriculture|ag|farm"), ("Agricultural Real Estate",), veto=word("line|operating")),
    Rule(word("commercial re|commercial real estate|cre"), ("Commercial Real Estate",)),
)


def _chain(text: Column, rules: Sequence[Rule], pick: Callable[[Rule], Column], default: Column) -> Column:
    out = default
    for rule in reversed(rules):
        out = F.when(fires(text, rule), pick(rule)).otherwise(out)
    return out


def lookup(value: Column, table: dict[str, str]) -> Column:
    out = F.lit(None).cast("string")
    for key, target in table.items():
        out = F.when(value == key, F.lit(target)).otherwise(out)
    return out


def purpose_lob(purpose: Column | str) -> Column:
    """Line of business of a purpose code, leading zeros ignored; null where it depends on context."""
    return lookup(F.ltrim(as_col(purpose).cast("string"), F.lit("0")), PURPOSE_LOB)


def customer_class_lob(value: Column | str) -> Column:
    return lookup(F.upper(F.trim(as_col(value))), CUSTOMER_CLASS_LOB)


def product_placement(name: Column | str, domain: Column | str, dominant_purpose: Column | str) -> Column:
    """Struct of the five product levels, confidence and reasoning.

    The name decides the line of business; the dominant purpose only breaks the tie of a silent name.
    """
    text = F.lower(F.coalesce(as_col(name), F.lit("")))
    by_purpose = purpose_lob(dominant_purpose)
    business, retail = _found(text, BUSINESS_WORDS), _found(text, RETAIL_WORDS)
    lob = (
        F.when(business, F.lit("Business"))
        .when(retail, F.lit("Retail"))
        .otherwise(F.coalesce(by_purpose, F.lit("Retail")))
    )
    signal = (
        F.when(business | retail, F.lit("name"))
        .when(by_purpose.isNotNull(), F.lit("purpose distribution"))
        .otherwise(F.lit("default"))
    )
    kind = F.when(as_col(domain).startswith("Deposit"), F.lit("Deposits")).otherwise(F.lit("Loans"))
    category, certainty = F.lit(UNCLASSIFIED), F.lit(UNPLACED)
    for needed, only, rule in reversed(PRODUCT_CATEGORY_RULES):
        fits = (kind == needed) & _found(text, rule.pattern)
        if only:
            fits = fits & (lob == only)
        category = F.when(fits, F.lit(rule.path[0])).otherwise(category)
        certainty = F.when(fits, F.lit(rule.confidence)).otherwise(certainty)

    def name_of(rule: Rule) -> Column:
        return F.lit(rule.path[0])

    none = F.lit(None).cast("string")
    return F.struct(
        lob.alias("line_of_business"),
        kind.alias("product_type"),
        category.alias("product_category"),
        _chain(text, SUBCATEGORY_RULES, name_of, none).alias("product_subcategory"),
        _chain(text, SPECIAL_RULES, name_of, none).alias("product_special"),
        certainty.alias("confidence"),
        F.concat(F.lit("line of business from "), signal).alias("reasoning"),
    )


# (category, rule) for the suggestion table, whose levels are named by meaning and written in capitals.
SUGGESTION_TYPE_RULES: tuple[tuple[str, Rule], ...] = (
    ("DEPOSITS", Rule(word("money market|mm|mmda"), ("MONEY MARKET",))),
    ("DEPOSITS", Rule(word("savings|saving|sav|hsa"), ("SAVINGS",))),
    ("DEPOSITS", Rule(word("checking|ck|chk|dda|club"), ("CHECKING",))),
    ("LOANS", Rule(word("cre|commercial real estate|commercial re"), ("COMMERCIAL REAL ESTATE",))),
    ("LOANS", Rule(word("heloc|home equity"), ("HOME EQUITY",))),
    ("LOANS", Rule(word("agricultural|agriculture|ag|farm"), ("AGRICULTURAL",))),
    ("LOANS", Rule(word("receivables|receivables-based"), ("RECEIVABLES-BASED",))),
    ("LOANS", Rule(word("equipment"), ("EQUIPMENT FINANCING",))),
    ("LOANS", Rule(word("mortgage|residential"), ("MORTGAGE",))),
    ("LOANS", Rule(word("real estate|re"), ("REAL ESTATE",))),
    ("LOANS", Rule(word("auto|vehicle"), ("AUTO",))),
    ("LOANS", Rule(word("line of credit|loc"), ("LINE OF CREDIT",))),
    ("LOANS", Rule(word("commercial|business"), ("COMMERCIAL",), confidence=0.8)),
    ("LOANS", Rule(word("personal|consumer|loan"), ("PERSONAL",), confidence=0.8)),
)
SERVICE_WORDS = word("online banking|mobile banking|bill pay|overdraft|safe deposit|debit cards")


def suggestion_placement(samples: Column | str) -> Column:
    """Struct of the suggestion levels from the most frequent description; null levels where nothing fits."""
    first = F.regexp_replace(F.element_at(F.split(as_col(samples), r" \| "), 1), r" \([0-9,]+\)$", "")
    text = F.lower(F.coalesce(as_col(samples), F.lit("")))
    fiduciary = _found(F.regexp_replace(text, "real estate", ""), FIDUCIARY_WORDS)
    lob = (
        F.when(fiduciary, F.lit("WEALTH MANAGEMENT"))
        .when(_found(text, BUSINESS_WORDS), F.lit("BUSINESS"))
        .otherwise(F.lit("RETAIL"))
    )
    none = F.lit(None).cast("string")
    kind, category, certainty = none, none, F.lit(UNPLACED)
    category = F.when(_found(text, SERVICE_WORDS), F.lit("SERVICES")).otherwise(category)
    for group, rule in reversed(SUGGESTION_TYPE_RULES):
        fits = _found(text, rule.pattern)
        kind = F.when(fits, F.lit(rule.path[0])).otherwise(kind)
        category = F.when(fits, F.lit(group)).otherwise(category)
        certainty = F.when(fits, F.lit(rule.confidence)).otherwise(certainty)
    special = _chain(text, SPECIAL_RULES, lambda r: F.upper(F.lit(r.path[0])), none)
    return F.struct(
        lob.alias("PROD_line_of_business"),
        category.alias("PROD_product_category"),
        kind.alias("PROD_product_type"),
        F.when(kind.isNotNull(), F.upper(first)).alias("PROD_product_name"),
        special.alias("PROD_product_code"),
        certainty.alias("confidence"),
    )


# --- the transaction rules in plain Python, for backends that run outside the JVM ---------------------------


def place_transaction(description: str | None) -> tuple[tuple[str | None, ...], float]:
    text = (description or "").lower()
    is_fee = re.search(FEE_WORDS, text) is not None
    for rule in FEE_BLOCK if is_fee else NON_FEE_RULES:
        if re.search(rule.pattern, text) and not (rule.veto and re.search(rule.veto, text)):
            return rule.path, rule.confidence
    return (_fee(UNCLASSIFIED) if is_fee else _non_fee(UNCLASSIFIED)), UNPLACED


def direction_of(description: str | None) -> str:
    text = (description or "").lower()
    return "Credit" if re.search(CREDIT_WORDS, text) and not re.search(DEBIT_WORDS, text) else "Debit"
