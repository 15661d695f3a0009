"""Stand-ins for institution data, derived by Spark from the whole test tables, and the same in SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from codeloom.operators.layers import assign_layers

# Descriptions handed out to the derived feeds.
# Invented descriptions for the rule tables to place.
TRANSACTION_TEXTS = (
    "ACH wages from the mill", "ACH rent to landlord", "ACH late return Fee", "ATM cash at kiosk 9", "ATM surcharge Fee", "ITM envelope deposit",
    "Check 412 cleared", "Cashier check bought", "Transfer between own accounts", "Loan payment by standing order", "Zelle from roommate",
    "Phone camera deposit", "Coin deposit at counter", "Co-op dividend paid in", "Counter withdrawal", "Cash advance taken at desk",
    "Wire in from supplier", "Foreign wire from Lisbon", "Domestic wire to broker", "Wire handling Fee",
    "POS grocery terminal 3", "POS gym every month", "NSF item presented twice", "Overdraft Fee of May", "Overdraft Fee reversal of May",
    "Refund of June NSF Fee", "Closing payout withdrawal", "Stop payment on check 88", "Stop payment request Charge", "Memo hold by hotel",
    "Interest on rainy day account", "CD interest third quarter", "Backup withholding to treasury", "Levy by the county", "Balance inquiry at night",
    "Posting error adjustment", "Investment buy order 17", "Cash management sweep in", "Monthly maintenance charge",
    "Account upkeep Fee", "Paper statement Fee", "Inactivity Fee", "Interchange settlement Fee", "Insufficient funds event Charge",
    "HSA top-up by employer", "Travel money Fee", "Lobby visit note", "Odd Fee", "Returned item Fee in May", "Bonus deposit",
)
PRODUCT_TEXTS = (
    "Everyday Checking", "Corner Shop Business Checking", "Rainy Day Savings", "Harbor Money Market", "Holiday Club Account",
    "Family HSA", "CD nine months", "Trust Fiduciary Interest", "Campus Checking", "Township Public Funds",
    "Residential Home Fixed 15", "CRE warehouse Fixed", "Agricultural land Fixed", "Home Equity revolving", "Used Auto note", "Night School Student Loan",
    "Tractor Equipment note", "Handshake Unsecured Consumer", "Commercial harbor Line", "Overdraft cushion",
    "Jumbo lakeside Mortgage ARM", "Note", "Minor's UTMA pot",
)
PURPOSE_TEXTS = (
    "household goods", "house for family", "office tower", "working capital", "orchard land", "harvest", "county bridge", "abroad",
    "bank to bank", "exempt bond", "",
)


# Declared schemas of the test tables: nothing has to be read to plan a query.
TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, "
              "o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
                "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "labels": "doc_id bigint, quality int, toxic int",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf}/{name}.parquet")


def pick(texts: tuple[str, ...], number: Column) -> Column:
    return F.element_at(F.array(*[F.lit(t) for t in texts]), (number % len(texts) + 1).cast("int"))


def pick_sql(texts: tuple[str, ...], number: str) -> str:
    listed = ", ".join("'" + t.replace("'", "''") + "'" for t in texts)
    return f"[{listed}][CAST({number} AS BIGINT) % {len(texts)} + 1]"


HISTORY_CODES = 60


def history(spark: SparkSession, sf: str) -> DataFrame:
    """Account history: one row per line item; codes come in both letter cases and padded."""
    number = F.col("l_partkey") % HISTORY_CODES
    code = F.concat(F.lit("p"), F.lpad(number.cast("string"), 2, "0"))
    live = (F.col("l_returnflag") == "A") & (number % 7 != 0)
    return table(spark, sf, "lineitem").select(
        F.when(F.col("l_linenumber") > 3, F.upper(code)).otherwise(F.concat(F.lit(" "), code)).alias("ProductInstanceReference"),
        F.when(F.col("l_tax") > 0.01, F.concat_ws(" ", pick(PRODUCT_TEXTS, number), "l_linestatus")).alias("ProductInstanceDescription"),
        F.when(live, "Active ").when(F.col("l_returnflag") == "N", "Closed").otherwise("Dormant").alias("AccountStatus"),
    )


def master(spark: SparkSession, sf: str) -> DataFrame:
    """Codes mapped already: one per nation."""
    code = F.concat(F.lit("P"), F.lpad(F.col("n_nationkey").cast("string"), 2, "0"))
    return table(spark, sf, "nation").select(
        F.concat(F.lit("  "), F.lower(code), F.lit(" ")).alias("PROD_core_system_mapping"),
        F.substring(F.sha2(code, 256), 1, 32).alias("PROD_product_type_id"),
    )


def code_of_part() -> Column:
    return F.concat_ws("-", "p_brand", F.col("p_size").cast("string"), F.floor(F.col("p_partkey") / 2000).cast("string"))


def coded_part(spark: SparkSession, sf: str) -> DataFrame:
    words = F.split("p_name", " ")
    return table(spark, sf, "part").select(
        "p_partkey", "p_type", "p_brand", code_of_part().alias("code"), F.col("p_name").alias("descr"),
        F.when(F.col("p_type").isin("PROMO", "ECONOMY"), "Fee item").otherwise("Non-fee item").alias("l1"),
        F.col("p_type").alias("l2"), words[0].alias("l3"),
        F.when(F.col("p_size") % 3 == 0, "N/A").otherwise(words[1]).alias("l4"),
    )


def truth(spark: SparkSession, sf: str) -> DataFrame:
    """Transaction truth: all parts but the STANDARD type, which the sheet does not cover."""
    return coded_part(spark, sf).filter(F.col("p_type") != "STANDARD").select(
        F.col("code").alias("transaction_code"), F.col("descr").alias("gt_desc"), F.col("l1").alias("gt_L1"),
        F.col("l2").alias("gt_L2"), F.col("l3").alias("gt_L3"), F.col("l4").alias("gt_L4"), "p_partkey",
    )


def raw_codes(spark: SparkSession, sf: str) -> DataFrame:
    """Volume per code; line items are counted per part before they meet the parts."""
    sold = table(spark, sf, "lineitem").groupBy("l_partkey").agg(F.count("*").alias("n"))
    part = table(spark, sf, "part").select("p_partkey", code_of_part().alias("transaction_code"))
    return sold.join(part, F.col("l_partkey") == F.col("p_partkey")).groupBy("transaction_code").agg(F.sum("n").alias("volume"))


def predictions(spark: SparkSession, sf: str) -> DataFrame:
    """Two result versions over all raw codes, with layers and batch figures."""
    parts = coded_part(spark, sf)
    other = F.col("p_partkey") % 2 * 1000000 + F.col("p_partkey")

    def first(column: str, order: Column) -> Column:
        return F.min_by(F.col(column), order)

    key = F.col("p_partkey")
    per_code = parts.groupBy("code").agg(
        first("descr", key).alias("description_samples"),
        F.upper(first("l1", key)).alias("a1"), first("l2", key).alias("a2"), first("l3", key).alias("a3"),
        F.nullif(first("l4", key), F.lit("N/A")).alias("a4"), (F.min(key) % 100 / 100.0).alias("ac"),
        first("l1", other).alias("b1"), first("l2", other).alias("b2"), F.max_by("l3", key).alias("b3"),
        F.concat(F.lit(" "), F.nullif(F.max_by("l4", key), F.lit("N/A"))).alias("b4"),
        (F.max(key) % 100 / 100.0).alias("bc"),
    )
    catalog = assign_layers(raw_codes(spark, sf), truth(spark, sf), "transaction_code", ("gt_L1", "gt_L2", "gt_L3", "gt_L4"))
    wide = catalog.join(per_code.withColumnRenamed("code", "transaction_code"), "transaction_code")

    def version(tag: str, letter: str) -> Column:
        return F.struct(
            F.lit(tag).alias("prompt_version"),
            *[F.col(f"{letter}{i}").alias(f"category_{i}") for i in range(1, 5)],
            F.col(f"{letter}c").alias("confidence"),
        )

    both = wide.select(
        "transaction_code", "description_samples", "volume", "layer",
        F.inline(F.array(version("v1", "a"), version("v2", "b"))),
    )
    batch = F.concat_ws("-", "prompt_version", F.split("transaction_code", "-")[0])
    tokens = F.length(batch) * 100
    price = F.when(F.col("prompt_version") == "v1", 0.003).otherwise(0.001)
    return both.select(
        "*", F.lit("NON_POS").alias("source_file"), F.lit("rules").alias("model_name"), batch.alias("batch_id"),
        tokens.cast("bigint").alias("tokens_in"), (tokens * 2).cast("bigint").alias("tokens_out"),
        (tokens * price / 1000).alias("estimated_cost"),
        F.when(F.col("prompt_version") == "v1", F.lit("2026-01-01 00:00:00")).otherwise("2026-02-01 00:00:00")
        .cast("timestamp").alias("run_timestamp"),
    )


def product_truth_rows(spark: SparkSession, sf: str) -> DataFrame:
    kind = F.col("p_type")
    lob = (
        F.when(kind.isin("PROMO", "ECONOMY"), "Retail").when(kind == "SMALL", "Business").when(kind == "LARGE", " business ")
        .when(kind == "MEDIUM", "Wealth Management")
    )
    words = F.split("p_name", " ")
    return table(spark, sf, "part").filter(F.col("p_brand") != "Brand#13").select(
        "p_partkey", code_of_part().alias("product_code"), F.col("p_name").alias("truth_name"),
        lob.alias("gt_L1_line_of_business"),
        F.when(F.col("p_size") % 2 == 0, "Deposits").otherwise("Loans").alias("gt_L2_type"),
        words[0].alias("gt_L3_category"),
        F.when(F.col("p_size") % 3 != 0, words[1]).alias("gt_L4_subcategory"),
        F.when(F.col("p_retailprice") > 1000, "Premium").alias("gt_L5_special"),
    )


def product_predictions(spark: SparkSession, sf: str) -> DataFrame:
    """One result version over all raw codes; layers come from the unfiltered truth."""
    spec = ("gt_L1_line_of_business", "gt_L2_type", "gt_L3_category", "gt_L4_subcategory", "gt_L5_special")
    key = F.col("p_partkey")
    words = F.split("p_name", " ")
    per_code = table(spark, sf, "part").groupBy(code_of_part().alias("product_code")).agg(
        F.min_by("p_name", key).alias("product_name"),
        F.when(F.min_by("p_type", key).isin("PROMO", "ECONOMY", "MEDIUM"), "retail").otherwise("BUSINESS").alias("line_of_business"),
        F.when(F.min("p_size") % 2 == 0, "Deposits").otherwise("Loans").alias("product_type"),
        F.min_by(words[0], key).alias("product_category"),
        F.max_by(words[1], key).alias("product_subcategory"),
        F.when(F.max("p_retailprice") > 1000, "Premium").alias("product_special"),
        (F.min(key) % 100 / 100.0).alias("confidence"),
    )
    counts = raw_codes(spark, sf).select(F.col("transaction_code").alias("product_code"), F.col("volume").alias("account_count"))
    catalog = assign_layers(counts, product_truth_rows(spark, sf), "product_code", spec)
    return catalog.join(per_code, "product_code").withColumns(
        {"source_file": F.lit("Deposit"), "prompt_version": F.lit("p1"), "model_name": F.lit("rules")}
    )


def feed(spark: SparkSession, sf: str) -> DataFrame:
    """Transaction feed: one row per line item, named by its part; two feeds by line status."""
    number = F.col("l_partkey")
    text = pick(TRANSACTION_TEXTS, number)
    return table(spark, sf, "lineitem").select(
        F.lpad((F.lit(100) + number % len(TRANSACTION_TEXTS)).cast("string"), 4, "0").alias("TRANCD"),
        F.concat_ws(" ", text, F.concat("l_returnflag", "l_linestatus")).alias("EFHDS1"),
        text.alias("description"), "l_linestatus",
    )


def deposits(spark: SparkSession, sf: str) -> DataFrame:
    """Deposit extract: one row per customer."""
    key = F.col("c_custkey")
    opened = F.date_add(F.lit("2020-01-01").cast("date"), (key % 1000).cast("int"))
    return table(spark, sf, "customer").select(
        F.concat(F.lit(" D"), key.cast("string")).alias("ACCTNO"),
        (key % 11).cast("string").alias("STATUS"),
        F.when(F.col("c_mktsegment") != "FURNITURE", F.concat(F.lpad(F.col("c_nationkey").cast("string"), 2, "0"), F.lit(" "))).alias("SCCODE"),
        F.col("c_mktsegment").alias("AccountBranch"),
        F.when(key % 3 == 0, F.date_format(opened, "M/d/yyyy")).when(key % 3 == 1, F.date_format(opened, "yyyy-MM-dd"))
        .otherwise("unknown").alias("Account_opened_date"),
        F.lit(None).cast("string").alias("account_close_date"),
    )


def type_list(spark: SparkSession, sf: str) -> DataFrame:
    """Type lookup with codes listed twice (the later row counts) and codes missing."""
    nation = table(spark, sf, "nation").filter(F.col("n_regionkey") != 4).select(
        F.lpad(F.col("n_nationkey").cast("string"), 2, "0").alias("code"),
        pick(PRODUCT_TEXTS, F.col("n_nationkey")).alias("description"), F.col("n_nationkey").cast("bigint").alias("rn"),
    )
    region = table(spark, sf, "region").select(
        F.lpad(F.col("r_regionkey").cast("string"), 2, "0").alias("code"),
        pick(PRODUCT_TEXTS, F.col("r_regionkey") + 7).alias("description"), (F.col("r_regionkey") + 100).cast("bigint").alias("rn"),
    )
    return nation.unionByName(region)


def loans(spark: SparkSession, sf: str) -> DataFrame:
    """Loan extract: one row per order; a customer's orders of one kind are snapshots of one loan."""
    key = F.col("o_orderkey")
    return table(spark, sf, "orders").select(
        F.concat(F.lit("L"), F.col("o_custkey").cast("string")).alias("acctno"),
        F.concat(F.substring("o_orderpriority", 1, 1), F.col("o_orderstatus")).alias("type"),
        (key % 9 + 1).cast("string").alias("STATUS"),
        F.concat((key % 11 + 1).cast("string"), F.lit(".0")).alias("PURCOD"),
        pick(PURPOSE_TEXTS, key).alias("PurposeDescription"),
        F.when(key % 5 != 0, pick(PRODUCT_TEXTS, F.ascii("o_orderpriority") + F.ascii("o_orderstatus"))).otherwise(F.lit("nan")).alias("LoanTypeDesc"),
        F.col("o_orderstatus").alias("Branch"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("DATOPN"),
        F.concat((key % 7).cast("string"), F.lit(".125")).alias("RATE"),
        key.alias("o_orderkey"),
    )


def loan_types(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select(
        F.concat(F.substring("o_orderpriority", 1, 1), F.col("o_orderstatus")).alias("code"), "o_orderstatus"
    ).distinct().filter(F.col("o_orderstatus") != "P").select(
        "code", F.concat(F.lit("Listed "), "code").alias("description"), F.lit(1).cast("bigint").alias("rn")
    )


# --- the same in SQL ----------------------------------------------------------------------------------------

CODE_SQL = "p_brand || '-' || CAST(p_size AS VARCHAR) || '-' || CAST(p_partkey // 2000 AS VARCHAR)"


def canon_sql(x: str) -> str:
    return (
        f"CASE WHEN {x} IS NULL OR lower(trim({x})) IN ('', 'none', 'nan', 'null', 'n/a') THEN '__null__' "
        f"ELSE lower(trim({x})) END"
    )


def lenient_sql(p: str, t: str) -> str:
    return f"(({canon_sql(t)}) = '__null__' OR ({canon_sql(p)}) = ({canon_sql(t)}))"


def strict_sql(p: str, t: str) -> str:
    return f"(({canon_sql(p)}) = ({canon_sql(t)}))"


LAYER_CASE = "CASE WHEN n_mappings IS NULL THEN 3 WHEN n_mappings > 1 THEN 2 ELSE 1 END"

CTES: dict[str, tuple[tuple[str, ...], str]] = {
    "ah": ((), f"""
        SELECT 'P' || lpad(CAST(l_partkey % {HISTORY_CODES} AS VARCHAR), 2, '0') AS product_ref,
               CASE WHEN l_tax > 0.01 THEN {pick_sql(PRODUCT_TEXTS, f'(l_partkey % {HISTORY_CODES})')} || ' ' || l_linestatus END AS product_desc,
               CASE WHEN l_returnflag = 'A' AND l_partkey % {HISTORY_CODES} % 7 <> 0 THEN 'ACTIVE' WHEN l_returnflag = 'N' THEN 'CLOSED' ELSE 'DORMANT' END AS account_status
        FROM lineitem"""),
    "master": ((), """
        SELECT '  ' || lower(code) || ' ' AS core_mapping, substr(sha256(code), 1, 32) AS type_id
        FROM (SELECT 'P' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS code FROM nation)"""),
    "coded_part": ((), f"""
        SELECT p_partkey, p_type, p_brand, {CODE_SQL} AS code, p_name AS descr,
               CASE WHEN p_type IN ('PROMO', 'ECONOMY') THEN 'Fee item' ELSE 'Non-fee item' END AS l1,
               p_type AS l2, split_part(p_name, ' ', 1) AS l3,
               CASE WHEN p_size % 3 = 0 THEN 'N/A' ELSE split_part(p_name, ' ', 2) END AS l4
        FROM part"""),
    "gt": (("coded_part",), """
        SELECT code AS transaction_code, descr AS gt_desc, l1 AS "gt_L1", l2 AS "gt_L2", l3 AS "gt_L3", l4 AS "gt_L4", p_partkey
        FROM coded_part WHERE p_type <> 'STANDARD'"""),
    "raw_codes": (("coded_part",), """
        SELECT code AS transaction_code, count(*) AS volume FROM lineitem JOIN coded_part ON l_partkey = p_partkey GROUP BY 1"""),
    "gt_counts": (("gt",), """
        SELECT transaction_code, count(DISTINCT ("gt_L1", "gt_L2", "gt_L3", "gt_L4")) AS n_mappings FROM gt GROUP BY 1"""),
    "gt_single": (("gt", "gt_counts"), """
        SELECT transaction_code, arg_min(gt_desc, p_partkey) AS gt_desc, any_value("gt_L1") AS "gt_L1", any_value("gt_L2") AS "gt_L2",
               any_value("gt_L3") AS "gt_L3", any_value("gt_L4") AS "gt_L4"
        FROM gt JOIN gt_counts USING (transaction_code) WHERE n_mappings = 1 GROUP BY 1"""),
    "pred": (("coded_part", "raw_codes", "gt_counts"), f"""
        SELECT v.*, volume, {LAYER_CASE} AS layer,
               prompt_version || '-' || split_part(transaction_code, '-', 1) AS batch_id,
               length(prompt_version || '-' || split_part(transaction_code, '-', 1)) * 100 AS tokens_in,
               length(prompt_version || '-' || split_part(transaction_code, '-', 1)) * 200 AS tokens_out,
               length(prompt_version || '-' || split_part(transaction_code, '-', 1)) * 100
                 * CASE WHEN prompt_version = 'v1' THEN 0.003::DOUBLE ELSE 0.001::DOUBLE END / 1000 AS estimated_cost
        FROM (
          SELECT 'v1' AS prompt_version, code AS transaction_code, arg_min(descr, p_partkey) AS description_samples,
                 upper(arg_min(l1, p_partkey)) AS category_1, arg_min(l2, p_partkey) AS category_2,
                 arg_min(l3, p_partkey) AS category_3, nullif(arg_min(l4, p_partkey), 'N/A') AS category_4,
                 CAST((min(p_partkey) % 100) / 100.0 AS DOUBLE) AS confidence
          FROM coded_part GROUP BY code
          UNION ALL
          SELECT 'v2', code, arg_min(descr, p_partkey), arg_min(l1, p_partkey % 2 * 1000000 + p_partkey),
                 arg_min(l2, p_partkey % 2 * 1000000 + p_partkey), arg_max(l3, p_partkey),
                 ' ' || nullif(arg_max(l4, p_partkey), 'N/A'), CAST((max(p_partkey) % 100) / 100.0 AS DOUBLE)
          FROM coded_part GROUP BY code
        ) v JOIN raw_codes USING (transaction_code) LEFT JOIN gt_counts USING (transaction_code)"""),
    "pgt_all": ((), f"""
        SELECT p_partkey, {CODE_SQL} AS product_code, p_name AS truth_name,
               CASE WHEN p_type IN ('PROMO', 'ECONOMY') THEN 'Retail' WHEN p_type = 'SMALL' THEN 'Business'
                    WHEN p_type = 'LARGE' THEN ' business ' WHEN p_type = 'MEDIUM' THEN 'Wealth Management' END AS g1,
               CASE WHEN p_size % 2 = 0 THEN 'Deposits' ELSE 'Loans' END AS g2, split_part(p_name, ' ', 1) AS g3,
               CASE WHEN p_size % 3 <> 0 THEN split_part(p_name, ' ', 2) END AS g4,
               CASE WHEN p_retailprice > 1000 THEN 'Premium' END AS g5
        FROM part WHERE p_brand <> 'Brand#13'"""),
    "pgt": (("pgt_all",), "SELECT * FROM pgt_all WHERE g1 IS NULL OR lower(trim(g1)) IN ('retail', 'business')"),
    "pgt_counts": (("pgt",), "SELECT product_code, count(DISTINCT (g1, g2, g3, g4, g5)) AS n FROM pgt GROUP BY 1"),
    "pgt_single": (("pgt", "pgt_counts"), """
        SELECT product_code, any_value(g1) AS g1, any_value(g2) AS g2, any_value(g3) AS g3, any_value(g4) AS g4, any_value(g5) AS g5
        FROM pgt JOIN pgt_counts USING (product_code) WHERE n = 1 GROUP BY 1"""),
    "ppred": (("pgt_all", "raw_codes"), f"""
        SELECT p.*, volume AS account_count, {LAYER_CASE} AS layer
        FROM (
          SELECT {CODE_SQL} AS product_code, arg_min(p_name, p_partkey) AS product_name,
                 CASE WHEN arg_min(p_type, p_partkey) IN ('PROMO', 'ECONOMY', 'MEDIUM') THEN 'retail' ELSE 'BUSINESS' END AS c1,
                 CASE WHEN min(p_size) % 2 = 0 THEN 'Deposits' ELSE 'Loans' END AS c2,
                 arg_min(split_part(p_name, ' ', 1), p_partkey) AS c3, arg_max(split_part(p_name, ' ', 2), p_partkey) AS c4,
                 CASE WHEN max(p_retailprice) > 1000 THEN 'Premium' END AS c5,
                 CAST((min(p_partkey) % 100) / 100.0 AS DOUBLE) AS confidence
          FROM part GROUP BY 1) p
        JOIN raw_codes ON product_code = transaction_code
        LEFT JOIN (SELECT product_code, count(DISTINCT (g1, g2, g3, g4, g5)) AS n_mappings FROM pgt_all GROUP BY 1) USING (product_code)"""),
    "feed": ((), f"""
        SELECT lpad(CAST(100 + l_partkey % {len(TRANSACTION_TEXTS)} AS VARCHAR), 4, '0') AS code,
               {pick_sql(TRANSACTION_TEXTS, 'l_partkey')} AS text,
               {pick_sql(TRANSACTION_TEXTS, 'l_partkey')} || ' ' || l_returnflag || l_linestatus AS line, l_linestatus
        FROM lineitem"""),
    "deposits": ((), """
        SELECT 'D' || c_custkey AS acctno, CAST(c_custkey % 11 AS VARCHAR) AS status,
               CASE WHEN c_mktsegment <> 'FURNITURE' THEN lpad(CAST(c_nationkey AS VARCHAR), 2, '0') END AS sccode,
               c_mktsegment AS branch,
               CASE WHEN c_custkey % 3 < 2 THEN DATE '2020-01-01' + CAST(c_custkey % 1000 AS INTEGER) END AS opened
        FROM customer"""),
    "types": ((), f"""
        SELECT code, arg_max(description, rn) AS description FROM (
          SELECT lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS code, {pick_sql(PRODUCT_TEXTS, 'n_nationkey')} AS description, n_nationkey AS rn
          FROM nation WHERE n_regionkey <> 4
          UNION ALL
          SELECT lpad(CAST(r_regionkey AS VARCHAR), 2, '0'), {pick_sql(PRODUCT_TEXTS, 'r_regionkey + 7')}, 100 + r_regionkey FROM region
        ) GROUP BY 1"""),
    "loans": ((), f"""
        SELECT 'L' || o_custkey AS acctno, substr(o_orderpriority, 1, 1) || o_orderstatus AS type, o_orderkey % 9 + 1 AS status,
               o_orderkey % 11 + 1 AS purcod, {pick_sql(PURPOSE_TEXTS, 'o_orderkey')} AS purpose,
               CASE WHEN o_orderkey % 5 <> 0 THEN {pick_sql(PRODUCT_TEXTS, 'ascii(o_orderpriority) + ascii(o_orderstatus)')} ELSE 'nan' END AS loantype,
               o_orderstatus AS branch, CAST(o_orderdate AS DATE) AS opened, (o_orderkey % 7) + 0.125 AS rate, o_orderkey
        FROM orders"""),
    "loan_types": ((), """
        SELECT DISTINCT substr(o_orderpriority, 1, 1) || o_orderstatus AS code, 'Listed ' || substr(o_orderpriority, 1, 1) || o_orderstatus AS description
        FROM orders WHERE o_orderstatus <> 'P'"""),
}


def with_views(names: str, body: str) -> str:
    """``body`` behind the named views and whatever they need."""
    ordered: list[str] = []

    def need(name: str) -> None:
        for other in CTES[name][0]:
            need(other)
        if name not in ordered:
            ordered.append(name)

    for name in names.split():
        need(name)
    ctes = ",\n".join(f"{n} AS ({CTES[n][1]})" for n in ordered)
    if body.lstrip().upper().startswith("WITH "):
        return f"WITH {ctes},\n{body.lstrip()[5:]}"
    return f"WITH {ctes}\n{body}"
