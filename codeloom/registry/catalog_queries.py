"""Queries over catalogs, truth sheets, normalization and readers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from codeloom.functions import parse, text
from codeloom.functions.levels import TRANSACTION, layer_name
from codeloom.operators import frequency, layers, normalize, ordering, profile
from codeloom.plans import account_history as history_plan
from codeloom.plans import catalogs, ground_truth, incremental
from codeloom.plans.uncategorized import uncategorized_catalog
from codeloom.registry import views as v
from codeloom.session import settle, work_dir
from codeloom.sources import ragged

Query = tuple[Callable[[SparkSession, str], DataFrame], str | None]
QUERIES: dict[str, Query] = {}


def query(name: str, sql: str | None = None):
    def register(build):
        QUERIES[name] = (build, sql)
        return build

    return register


SAMPLES_SQL = "string_agg({t} || ' (' || format('{{:,}}', n) || ')', ' | ' ORDER BY rn)"


@query("q_uncategorized_catalog", v.with_views("ah master", f"""
WITH u AS (SELECT upper(trim(product_ref)) AS product_code, trim(product_desc) AS t, account_status FROM ah
           WHERE NOT EXISTS (SELECT 1 FROM master WHERE upper(trim(core_mapping)) = upper(trim(product_ref)))),
     codes AS (SELECT product_code, count(*) AS volume,
                      CASE WHEN sum(CASE WHEN account_status = 'ACTIVE' THEN 1 ELSE 0 END) > 0 THEN 'ACTIVE' ELSE 'INACTIVE' END AS prod_status
               FROM u GROUP BY 1),
     counted AS (SELECT product_code, t, count(*) AS n FROM u WHERE t <> '' GROUP BY 1, 2),
     r AS (SELECT *, row_number() OVER (PARTITION BY product_code ORDER BY n DESC, t) AS rn FROM counted)
SELECT c.product_code, any_value(volume) AS volume, any_value(prod_status) AS prod_status,
       coalesce({SAMPLES_SQL.format(t='t')}, '(no description)') AS description_samples
FROM codes c LEFT JOIN r ON c.product_code = r.product_code AND rn <= 3 GROUP BY 1"""))
def q_uncategorized_catalog(spark: SparkSession, sf: str) -> DataFrame:
    return uncategorized_catalog(v.history(spark, sf), v.master(spark, sf))


@query("q_code_volume", """
SELECT event_type AS code, count(*) AS volume, 'events' AS source_file FROM events GROUP BY 1
UNION ALL SELECT p_brand, count(*), 'lineitem' FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1""")
def q_code_volume(spark: SparkSession, sf: str) -> DataFrame:
    events = frequency.code_volume(v.table(spark, sf, "events").select(F.col("event_type").alias("code")), "code")
    sold = v.table(spark, sf, "lineitem").groupBy("l_partkey").agg(F.count("*").alias("n"))
    brands = v.table(spark, sf, "part").select("p_partkey", F.col("p_brand").alias("code"))
    lines = sold.join(brands, F.col("l_partkey") == F.col("p_partkey")).groupBy("code").agg(F.sum("n").alias("volume"))
    return events.withColumn("source_file", F.lit("events")).unionByName(
        lines.withColumn("source_file", F.lit("lineitem"))
    )


@query("q_distinct_codes", v.with_views("feed", "SELECT count(DISTINCT code) AS codes FROM feed"))
def q_distinct_codes(spark: SparkSession, sf: str) -> DataFrame:
    return frequency.distinct_codes(v.feed(spark, sf), "TRANCD")


@query("q_value_counts", """
SELECT role, count(*) AS count FROM conversations GROUP BY 1""")
def q_value_counts(spark: SparkSession, sf: str) -> DataFrame:
    return frequency.value_counts(v.table(spark, sf, "conversations"), "role", keep_null=True)


@query("q_sorted_values", "SELECT DISTINCT user_id FROM events ORDER BY 1")
def q_sorted_values(spark: SparkSession, sf: str) -> DataFrame:
    return frequency.sorted_distinct(v.table(spark, sf, "events"), "user_id")


@query("q_top_descriptions", v.with_views("feed", f"""
WITH counted AS (SELECT code, line AS t, count(*) AS n FROM feed GROUP BY 1, 2),
     r AS (SELECT *, row_number() OVER (PARTITION BY code ORDER BY n DESC, t) AS rn FROM counted),
     vol AS (SELECT code, count(*) AS volume FROM feed GROUP BY 1)
SELECT code AS "TRANCD", any_value(volume) AS volume, {SAMPLES_SQL.format(t='t')} AS description_samples
FROM vol JOIN r USING (code) WHERE rn <= 5 GROUP BY 1"""))
def q_top_descriptions(spark: SparkSession, sf: str) -> DataFrame:
    return frequency.top_descriptions(v.feed(spark, sf), "TRANCD", "EFHDS1", 5)


@query("q_top_codes", v.with_views("raw_codes", """
SELECT transaction_code, volume FROM raw_codes ORDER BY volume DESC, transaction_code LIMIT 10"""))
def q_top_codes(spark: SparkSession, sf: str) -> DataFrame:
    return ordering.top_k(v.raw_codes(spark, sf), [F.desc("volume"), "transaction_code"], 10)


@query("q_distribution", """
WITH c AS (SELECT p_brand AS code, l_linenumber AS value, count(*) AS n FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2),
     r AS (SELECT *, row_number() OVER (PARTITION BY code ORDER BY n DESC, value) AS rn, sum(n) OVER (PARTITION BY code) AS total FROM c)
SELECT code, value, CAST(rn AS INTEGER) AS rn, n, round_even(n / total, 3) AS share FROM r WHERE rn <= 5""")
def q_distribution(spark: SparkSession, sf: str) -> DataFrame:
    # Counted per part before the join, so that a part with very many lines is one row per value.
    line = v.table(spark, sf, "lineitem").groupBy("l_partkey", F.col("l_linenumber").alias("value")).agg(F.count("*").alias("lines"))
    part = v.table(spark, sf, "part").select("p_partkey", F.col("p_brand").alias("code"))
    rows = line.join(part, F.col("l_partkey") == F.col("p_partkey"))
    return frequency.distribution(rows, "code", "value", 5, count=F.col("lines"))


STATUS_SQL = "CASE o_orderstatus WHEN 'O' THEN 'ACTIVE' WHEN 'F' THEN 'CLOSED' ELSE 'PENDING' END"


def _order_states(spark: SparkSession, sf: str) -> DataFrame:
    state = F.when(F.col("o_orderstatus") == "O", "ACTIVE").when(F.col("o_orderstatus") == "F", "CLOSED").otherwise("PENDING")
    return v.table(spark, sf, "orders").select("o_custkey", state.alias("state"))


@query("q_prod_status", f"""
SELECT o_custkey, CASE WHEN bool_or({STATUS_SQL} = 'ACTIVE') THEN 'ACTIVE' ELSE 'INACTIVE' END AS prod_status FROM orders GROUP BY 1""")
def q_prod_status(spark: SparkSession, sf: str) -> DataFrame:
    return _order_states(spark, sf).groupBy("o_custkey").agg(
        frequency.status_any_active(F.col("state")).alias("prod_status")
    )


@query("q_prod_status_mode", f"""
SELECT o_custkey, CASE WHEN bool_or({STATUS_SQL} = 'ACTIVE') THEN 'ACTIVE'
                       WHEN count(*) FILTER ({STATUS_SQL} = 'CLOSED') = 0 THEN 'ACTIVE' ELSE 'INACTIVE' END AS prod_status
FROM orders GROUP BY 1""")
def q_prod_status_mode(spark: SparkSession, sf: str) -> DataFrame:
    return _order_states(spark, sf).groupBy("o_custkey").agg(
        frequency.status_most_common(F.col("state")).alias("prod_status")
    )


LINE_ORDER = (
    "l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount",
    "l_tax", "l_returnflag", "l_linestatus",
)


@query("q_dedupe_first", f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, strftime(l_shipdate, '%Y-%m-%d') AS shipped FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {', '.join(LINE_ORDER)}) = 1""")
def q_dedupe_first(spark: SparkSession, sf: str) -> DataFrame:
    rows = ordering.first_per_key(v.table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], LINE_ORDER)
    shipped = F.date_format("l_shipdate", "yyyy-MM-dd").alias("shipped")
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", shipped)


@query("q_cap_per_code", f"""
SELECT l_suppkey, l_orderkey, l_linenumber, l_partkey, strftime(l_shipdate, '%Y-%m-%d') AS shipped FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_suppkey ORDER BY {', '.join(LINE_ORDER)}) <= 50""")
def q_cap_per_code(spark: SparkSession, sf: str) -> DataFrame:
    rows = ordering.cap_per_key(v.table(spark, sf, "lineitem"), ["l_suppkey"], LINE_ORDER, 50)
    shipped = F.date_format("l_shipdate", "yyyy-MM-dd").alias("shipped")
    return rows.select("l_suppkey", "l_orderkey", "l_linenumber", "l_partkey", shipped)


@query("q_running_total", """
SELECT l_orderkey, l_linestatus, n, CAST(sum(n) OVER (PARTITION BY l_linestatus ORDER BY l_orderkey) AS BIGINT) AS upto
FROM (SELECT l_orderkey, l_linestatus, count(*) AS n FROM lineitem GROUP BY 1, 2)""")
def q_running_total(spark: SparkSession, sf: str) -> DataFrame:
    counts = v.table(spark, sf, "lineitem").groupBy("l_orderkey", "l_linestatus").agg(F.count("*").alias("n"))
    return ordering.running_total(counts, ["l_linestatus"], ["l_orderkey"], F.col("n"), "upto")


def _states_sql(states: dict[int, str]) -> str:
    return "CASE " + " ".join(f"WHEN o_orderkey % 11 = {k} THEN '{s}'" for k, s in states.items()) + " ELSE 'ACTIVE' END"


@query("q_status_map", f"""
SELECT o_orderkey, {_states_sql(normalize.DEPOSIT_STATES)} AS deposit_state, {_states_sql(normalize.LOAN_STATES)} AS loan_state,
       o_orderkey % 11 IN {normalize.DEPOSIT_INCLUDED} AS deposit_kept, o_orderkey % 11 IN {normalize.LOAN_INCLUDED} AS loan_kept
FROM orders""")
def q_status_map(spark: SparkSession, sf: str) -> DataFrame:
    raw = F.concat(F.lit(" "), (F.col("o_orderkey") % 11).cast("string"), F.lit(".0"))
    orders = v.table(spark, sf, "orders").select("o_orderkey", raw.alias("status"))
    return orders.select(
        "o_orderkey",
        normalize.map_states("status", normalize.DEPOSIT_STATES).alias("deposit_state"),
        normalize.map_states("status", normalize.LOAN_STATES).alias("loan_state"),
        parse.to_status("status").isin(*normalize.DEPOSIT_INCLUDED).alias("deposit_kept"),
        parse.to_status("status").isin(*normalize.LOAN_INCLUDED).alias("loan_kept"),
    )


@query("q_status_filter", f"""
SELECT count(*) AS rows_before, count(*) FILTER (o_orderkey % 11 IN {normalize.DEPOSIT_INCLUDED}) AS rows_after FROM orders""")
def q_status_filter(spark: SparkSession, sf: str) -> DataFrame:
    """Rows before and after the status filter."""
    status = parse.to_status((F.col("o_orderkey") % 11).cast("string"))
    return v.table(spark, sf, "orders").agg(
        F.count("*").alias("rows_before"), F.count_if(status.isin(*normalize.DEPOSIT_INCLUDED)).alias("rows_after")
    )


@query("q_desc_lookup", """
WITH l AS (SELECT s_nationkey AS k, arg_max(s_name, s_suppkey) AS t FROM supplier GROUP BY 1)
SELECT c_custkey, coalesce(t, CASE WHEN c_mktsegment <> 'BUILDING' THEN c_mktsegment END, '(unknown)') AS description
FROM customer LEFT JOIN l ON c_nationkey = k""")
def q_desc_lookup(spark: SparkSession, sf: str) -> DataFrame:
    lookup = v.table(spark, sf, "supplier").select(
        F.concat(F.lit(" "), F.col("s_nationkey").cast("string")).alias("code"), F.col("s_name").alias("text"), "s_suppkey"
    )
    rows = v.table(spark, sf, "customer").select(
        "c_custkey", F.col("c_nationkey").cast("string").alias("code"),
        F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_mktsegment")).alias("sample"),
    )
    named = normalize.lookup_text(
        rows, "code", lookup, "code", "text", "s_suppkey", [F.col("sample"), F.lit(text.UNKNOWN)], "description"
    )
    return named.select("c_custkey", "description")


@query("q_norm_map", v.with_views("coded_part", """
SELECT p_partkey, CASE l1 WHEN 'Fee item' THEN 'Fee' ELSE l1 END AS l1,
       CASE l2 WHEN 'PROMO' THEN 'Promotion' WHEN 'ECONOMY' THEN NULL ELSE l2 END AS l2,
       l3, CASE l4 WHEN 'N/A' THEN NULL ELSE l4 END AS l4
FROM coded_part"""))
def q_norm_map(spark: SparkSession, sf: str) -> DataFrame:
    maps = {
        "l1": {"Fee item": "Fee"}, "l2": {"PROMO": "Promotion", "ECONOMY": None}, "l4": {"N/A": None, "nan": None},
    }
    return normalize.apply_maps(v.coded_part(spark, sf), maps).select("p_partkey", "l1", "l2", "l3", "l4")


@query("q_norm_map_table", """
SELECT c_custkey, CASE WHEN n_regionkey = 2 THEN NULL WHEN n_regionkey < 2 THEN 'N' || n_nationkey ELSE CAST(c_nationkey AS VARCHAR) END AS nation
FROM customer JOIN nation ON c_nationkey = n_nationkey""")
def q_norm_map_table(spark: SparkSession, sf: str) -> DataFrame:
    nation = v.table(spark, sf, "nation")
    mapping = nation.filter(F.col("n_regionkey") <= 2).select(
        F.col("n_nationkey").cast("string").alias("from"),
        F.when(F.col("n_regionkey") < 2, F.concat(F.lit("N"), F.col("n_nationkey").cast("string"))).alias("to"),
    )
    rows = v.table(spark, sf, "customer").select("c_custkey", F.col("c_nationkey").cast("string").alias("nation"))
    return normalize.apply_map_table(rows, "nation", mapping, "from", "to")


SHEET_CODE_SQL = """CASE WHEN p_size % 7 = 0 THEN '' WHEN p_size % 11 = 0 THEN 'nan' WHEN p_size % 13 = 0 THEN 'X' || p_partkey
            WHEN p_size % 17 = 0 THEN NULL ELSE '0' || p_partkey END"""


@query("q_gt_clean", v.with_views("coded_part", f"""
WITH s AS (SELECT {SHEET_CODE_SQL} AS transaction_code, descr AS gt_desc,
                  CASE WHEN p_size % 5 = 0 THEN 'Scoring Category 1' ELSE l1 END AS l1, l2, l3, l4, CAST(NULL AS VARCHAR) AS cd
           FROM coded_part JOIN part USING (p_partkey))
SELECT transaction_code, gt_desc, l1 AS "gt_L1", CASE l2 WHEN 'LARGE' THEN 'Money movement' ELSE l2 END AS "gt_L2",
       CASE WHEN l3 = 'red' THEN NULL ELSE l3 END AS "gt_L3", nullif(l4, 'N/A') AS "gt_L4", CASE WHEN l4 = 'N/A' THEN NULL ELSE 'Debit' END AS "gt_credit_debit"
FROM s WHERE regexp_full_match(transaction_code, '[0-9]+') AND l1 <> 'Scoring Category 1'"""))
def q_gt_clean(spark: SparkSession, sf: str) -> DataFrame:
    """A messy truth sheet made of all parts, cleaned."""
    size = F.col("p_size")
    code = (
        F.when(size % 7 == 0, "  ").when(size % 11 == 0, "nan").when(size % 13 == 0, F.concat(F.lit("X"), "p_partkey"))
        .when(size % 17 == 0, F.lit(None).cast("string")).otherwise(F.concat(F.lit(" 0"), "p_partkey", F.lit("\n")))
    )
    parts = v.coded_part(spark, sf).join(v.table(spark, sf, "part").select("p_partkey", "p_size"), "p_partkey")
    level2 = F.when(F.col("l2") == "LARGE", "Money Movement").otherwise(F.col("l2"))
    level3 = F.when(F.col("l3") == "red", " N/A").otherwise(F.col("l3"))
    sheet = parts.select(
        code.alias("External Transaction Code"), F.concat(F.lit("\t"), "descr").alias("External Transaction Description"),
        F.when(size % 5 == 0, "Scoring Category 1 ").when(F.col("l1") == "Fee item", "Fee Item").otherwise(F.col("l1")).alias("Scoring Category 1"),
        level2.alias("Scoring Category 2"), level3.alias("Scoring Category 3"), F.col("l4").alias("Scoring Category 4"),
        F.when(F.col("l4") == "N/A", "nan").otherwise("Debit").alias("Credit / Debit"),
    )
    return ground_truth.transaction_truth(sheet)


def _sheet(spark: SparkSession, sf: str) -> DataFrame:
    """One product sheet per region: unmapped codes, a blank row, the heading, then headers and codes."""
    nation = v.table(spark, sf, "nation")
    region = v.table(spark, sf, "region")
    supplier = v.table(spark, sf, "supplier")
    none = F.lit(None).cast("string")
    named = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    located = supplier.join(named, F.col("s_nationkey") == F.col("n_nationkey"))
    width = 10_000_000_000
    start = (F.col("n_nationkey").cast("bigint") + 1) * width
    bucket = F.floor(F.col("s_suppkey") / 10)

    def rows(frame: DataFrame, rn, *cells) -> DataFrame:
        padded = [*cells, *[none] * (7 - len(cells))]
        return frame.select(
            F.col("r_name").alias("sheet"), rn.cast("bigint").alias("rn"), *[c.alias(f"c{i}") for i, c in enumerate(padded)]
        )

    blank = [none] * 2
    parts = [
        rows(named, F.col("n_nationkey") - 1000, F.concat(F.lit("U"), "n_nationkey"), F.col("n_name")),
        rows(region, F.lit(-500), none),
        rows(region, F.lit(-1), F.lit(" LoB "), F.lit("Type")),
        rows(region, F.lit(0), F.col("r_name")),
        rows(named, start, none, F.concat("n_name", F.lit("\n x"))),
        rows(located.filter(bucket % 2 == 0).select("r_name", start.alias("start"), bucket.alias("bucket")).distinct(),
             F.col("start") + F.col("bucket") * 20 + 1, *blank, F.concat(F.lit("B"), F.col("bucket").cast("string"))),
        rows(located, start + bucket * 20 + F.col("s_suppkey") % 10 + 2, *blank, none, none, none,
             F.concat(F.lit("S"), F.col("s_suppkey").cast("string")), F.concat(F.lit(" "), "s_name")),
    ]
    sheet = parts[0]
    for part in parts[1:]:
        sheet = sheet.unionByName(part)
    return settle(sheet)


@query("q_hier_ffill", """
WITH s AS (SELECT *, s_suppkey // 10 AS b FROM supplier),
     f AS (SELECT *, max(CASE WHEN b % 2 = 0 THEN b END) OVER (PARTITION BY s_nationkey ORDER BY s_suppkey) AS live FROM s)
SELECT 'S' || s_suppkey AS product_code, s_name AS product_name, r_name AS "gt_L1_line_of_business", n_name || ' x' AS "gt_L2_type",
       'B' || live AS "gt_L3_category", CAST(NULL AS VARCHAR) AS "gt_L4_subcategory", CAST(NULL AS VARCHAR) AS "gt_L5_special",
       'Deposits' AS product_domain
FROM f JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""")
def q_hier_ffill(spark: SparkSession, sf: str) -> DataFrame:
    return ground_truth.product_truth(_sheet(spark, sf), "Deposits")


@query("q_unmapped_block", "SELECT 'U' || n_nationkey AS product_code, n_name AS product_name FROM nation")
def q_unmapped_block(spark: SparkSession, sf: str) -> DataFrame:
    return ground_truth.unmapped_block(_sheet(spark, sf), ["Level configuration"])


CSV_HEADER = ("A", "B", "C", "D", "E", "F", "DESC1", "DESC2", "T1", "T2")
FLAT_SQL = "replace(replace(replace(replace(text, chr(10), ' '), chr(13), ' '), '\"', ''), chr(0), '')"


def _flat_text():
    return F.translate("text", "\n\r\"", "  ")


@query("q_ragged_csv", f"""
SELECT CAST(doc_id AS VARCHAR) AS "A", lang AS "B", source AS "C", CAST(n_chars AS VARCHAR) AS "D", CAST(doc_id % 100 AS VARCHAR) AS "E",
       CAST(n_chars % 7 AS VARCHAR) AS "F", {FLAT_SQL} AS "DESC1", source AS "DESC2", lang AS "T1", CAST(doc_id AS VARCHAR) AS "T2"
FROM documents""")
def q_ragged_csv(spark: SparkSession, sf: str) -> DataFrame:
    """Lines made of whole documents, commas unquoted, a NUL in each; the reader must give the fields back."""
    quoted = F.concat(F.lit('"'), "source", F.lit('"'))
    lines = v.table(spark, sf, "documents").select(
        F.concat_ws(
            ",", F.col("doc_id").cast("string"), "lang", quoted, F.col("n_chars").cast("string"),
            (F.col("doc_id") % 100).cast("string"), (F.col("n_chars") % 7).cast("string"),
            F.concat(F.lit("\x00"), _flat_text()), "source", "lang", F.col("doc_id").cast("string"),
        ).alias("value")
    )
    rows, _ = ragged.repair(lines, CSV_HEADER)
    return rows.drop("_repaired")


@query("q_ragged_rejects", f"""
WITH l AS (SELECT 5 + length({FLAT_SQL}) - length(replace({FLAT_SQL}, ',', '')) AS n FROM conversations)
SELECT count(*) FILTER (n = 10) AS sound, count(*) FILTER (n > 10) AS repaired, count(*) FILTER (n < 10) AS rejected FROM l""")
def q_ragged_rejects(spark: SparkSession, sf: str) -> DataFrame:
    lines = v.table(spark, sf, "conversations").select(
        F.concat_ws(",", F.col("conv_id").cast("string"), F.col("turn").cast("string"), "role", _flat_text(), F.lit("end")).alias("value")
    )
    return ragged.repair_counts(lines, len(CSV_HEADER))


@query("q_ragged_parallel", """
SELECT CAST(doc_id AS VARCHAR) AS "A", lang AS "B", sha256(replace(text, chr(0), '')) AS "DESC1", source AS "DESC2", CAST(n_chars AS VARCHAR) AS "T2"
FROM documents""")
def q_ragged_parallel(spark: SparkSession, sf: str) -> DataFrame:
    """Whole documents with their line breaks as quoted fields of delimited files, cut into records by byte ranges and read back."""
    def quoted(column: str) -> Column:
        return F.concat(F.lit('"'), F.replace(column, F.lit('"'), F.lit('""')), F.lit('"'))

    docs = v.table(spark, sf, "documents")
    path = work_dir(spark, "ragged")
    docs.select(F.concat_ws(
        ",", F.col("doc_id").cast("string"), "lang", *[F.lit(c) for c in "cdef"], quoted("text"), quoted("source"), F.lit("t1"), F.col("n_chars").cast("string"),
    ).alias("value")).write.text(path)
    rows, _ = ragged.read_ragged(spark, path, CSV_HEADER, multiline=True)
    return rows.select("A", "B", F.sha2("DESC1", 256).alias("DESC1"), "DESC2", "T2")


@query("q_layer_assign", v.with_views("raw_codes gt_counts", f"""
SELECT transaction_code, volume, {v.LAYER_CASE} AS layer FROM raw_codes LEFT JOIN gt_counts USING (transaction_code)"""))
def q_layer_assign(spark: SparkSession, sf: str) -> DataFrame:
    return layers.assign_layers(v.raw_codes(spark, sf), v.truth(spark, sf), "transaction_code", TRANSACTION.truth)


@query("q_layer_summary", v.with_views("raw_codes gt_counts", f"""
WITH c AS (SELECT transaction_code, volume, {v.LAYER_CASE} AS layer FROM raw_codes LEFT JOIN gt_counts USING (transaction_code))
SELECT layer, CASE layer WHEN 1 THEN 'Obvious' WHEN 2 THEN 'Ambiguous' ELSE 'Unknown' END AS name, count(DISTINCT transaction_code) AS codes,
       CAST(sum(volume) AS BIGINT) AS total, round_even(sum(volume) / (SELECT sum(volume) FROM c) * 100, 1) AS pct
FROM c GROUP BY 1"""))
def q_layer_summary(spark: SparkSession, sf: str) -> DataFrame:
    return layers.layer_summary(q_layer_assign(spark, sf), "transaction_code", "volume")


@query("q_layer_listing", v.with_views("raw_codes gt_counts", f"""
SELECT transaction_code, volume, {v.LAYER_CASE} AS layer, CASE {v.LAYER_CASE} WHEN 1 THEN 'Obvious' WHEN 2 THEN 'Ambiguous' ELSE 'Unknown' END AS name
FROM raw_codes LEFT JOIN gt_counts USING (transaction_code)"""))
def q_layer_listing(spark: SparkSession, sf: str) -> DataFrame:
    listed = layers.layer_listing(q_layer_assign(spark, sf), "transaction_code", "volume")
    return listed.withColumn("name", layer_name("layer"))


@query("q_truth_coverage", v.with_views("raw_codes gt", """
WITH r AS (SELECT transaction_code IN (SELECT transaction_code FROM gt) AS known FROM raw_codes)
SELECT count(*) FILTER (known) AS mapped, count(*) FILTER (NOT known) AS unmapped, round(count(*) FILTER (known) / count(*), 6) AS share FROM r"""))
def q_truth_coverage(spark: SparkSession, sf: str) -> DataFrame:
    return layers.truth_coverage(v.raw_codes(spark, sf), v.truth(spark, sf), "transaction_code")


@query("q_transaction_catalog", v.with_views("feed", f"""
WITH f AS (SELECT code, line AS t, 'NON_POS' AS source_file FROM feed WHERE l_linestatus = 'F'
           UNION ALL SELECT code, text, 'POS' FROM feed WHERE l_linestatus = 'O'),
     counted AS (SELECT source_file, code, t, count(*) AS n FROM f GROUP BY 1, 2, 3),
     r AS (SELECT *, row_number() OVER (PARTITION BY source_file, code ORDER BY n DESC, t) AS rn, sum(n) OVER (PARTITION BY source_file, code) AS volume FROM counted),
     g AS (SELECT DISTINCT code, CASE WHEN ends_with(text, 'Fee') THEN 'Fee item' ELSE 'Non-fee item' END AS l1,
                  CASE WHEN starts_with(text, 'ACH') THEN l_linestatus END AS l2 FROM feed WHERE NOT starts_with(text, 'POS')),
     c AS (SELECT code, count(*) AS n_mappings FROM g GROUP BY 1)
SELECT code AS transaction_code, source_file, CAST(any_value(volume) AS BIGINT) AS volume,
       {SAMPLES_SQL.format(t='t')} FILTER (rn <= 5) AS description_samples, any_value({v.LAYER_CASE}) AS layer
FROM r LEFT JOIN c USING (code) GROUP BY 1, 2"""))
def q_transaction_catalog(spark: SparkSession, sf: str) -> DataFrame:
    """Two feeds to one catalog with layers; the truth knows no card codes and two paths for ACH codes."""
    feed = v.feed(spark, sf)
    other = feed.filter(F.col("l_linestatus") == "F")
    cards = feed.filter(F.col("l_linestatus") == "O")
    named = F.col("description")
    none = F.lit(None).cast("string")
    truth = feed.filter(~named.startswith("POS")).select(
        F.col("TRANCD").alias("transaction_code"),
        F.when(named.endswith("Fee"), "Fee item").otherwise("Non-fee item").alias("gt_L1"),
        F.when(named.startswith("ACH"), F.col("l_linestatus")).alias("gt_L2"), none.alias("gt_L3"), none.alias("gt_L4"),
    ).distinct()
    return catalogs.combined_transaction_catalog(
        [
            catalogs.transaction_catalog(other, "NON_POS"),
            catalogs.transaction_catalog(cards, "POS", text="transaction_desc"),
        ],
        truth,
    )


@query("q_catalog_incremental", f"""
WITH f AS (SELECT lpad(CAST(100 + l_partkey % {len(v.TRANSACTION_TEXTS)} AS VARCHAR), 4, '0') AS code,
                  {v.pick_sql(v.TRANSACTION_TEXTS, 'l_partkey')} || ' ' || l_returnflag || l_linestatus AS t, l_linenumber AS line
           FROM lineitem WHERE l_orderkey % 10 <> 9),
     texts AS (SELECT code, t, count(*) AS n, row_number() OVER (PARTITION BY code ORDER BY count(*) DESC, t) AS rn FROM f GROUP BY 1, 2),
     lines AS (SELECT code, line, count(*) AS n, sum(count(*)) OVER (PARTITION BY code) AS total,
                      row_number() OVER (PARTITION BY code ORDER BY count(*) DESC, line) AS rn FROM f GROUP BY 1, 2),
     shown AS (SELECT code, '{{' || string_agg('"' || line || '": ' || CAST(round_even(n / total, 3) AS VARCHAR), ', ' ORDER BY rn) || '}}' AS lines
               FROM lines WHERE rn <= 5 GROUP BY 1)
SELECT code, CAST(sum(n) AS BIGINT) AS volume, {SAMPLES_SQL.format(t='t')} FILTER (rn <= 5) AS description_samples, any_value(lines) AS lines
FROM texts JOIN shown USING (code) GROUP BY 1""")
def q_catalog_incremental(spark: SparkSession, sf: str) -> DataFrame:
    """A catalog loaded once and kept up by three deltas, the last of which takes back a tenth of what was loaded."""
    number, day = F.col("l_partkey"), F.col("l_orderkey") % 10
    feed = v.table(spark, sf, "lineitem").select(
        F.lpad((F.lit(100) + number % len(v.TRANSACTION_TEXTS)).cast("string"), 4, "0").alias("TRANCD"),
        F.concat_ws(" ", v.pick(v.TRANSACTION_TEXTS, number), F.concat("l_returnflag", "l_linestatus")).alias("EFHDS1"), "l_linenumber", day.alias("day"),
    )
    kinds = incremental.feed_kinds("EFHDS1", {"lines": F.col("l_linenumber")})
    path = work_dir(spark, "catalog")
    deltas = [(feed.filter("day NOT IN (7, 8)"), 1), (feed.filter("day = 7"), 1), (feed.filter("day = 8"), 1), (feed.filter("day = 9"), -1)]
    for n, (rows, sign) in enumerate(deltas):
        incremental.write_delta(incremental.signed_tally(rows, text.strip("TRANCD"), kinds, F.lit(sign)), path, n)
        if n == 1:
            incremental.compact(spark, path)
    return incremental.catalog(incremental.merged(spark, path), shown={"lines": lambda value: value.try_cast("double")})


@query("q_deposit_catalog", v.with_views("deposits types", f"""
SELECT sccode AS product_code, count(*) AS account_count, coalesce(any_value(description), '(unknown)') AS product_name, 'Deposit' AS source_file
FROM deposits LEFT JOIN types ON code = sccode
WHERE sccode IS NOT NULL AND CAST(status AS INTEGER) IN {normalize.DEPOSIT_INCLUDED} GROUP BY 1"""))
def q_deposit_catalog(spark: SparkSession, sf: str) -> DataFrame:
    return catalogs.deposit_catalog(v.deposits(spark, sf), v.type_list(spark, sf))


JSON_SQL = """(SELECT type, '{{' || string_agg('"' || val || '": ' || CAST(round_even(n / total, 3) AS VARCHAR), ', ' ORDER BY rn) || '}}' AS dist FROM (
        SELECT type, {value} AS val, count(*) AS n, sum(count(*)) OVER (PARTITION BY type) AS total,
               row_number() OVER (PARTITION BY type ORDER BY count(*) DESC, {value}) AS rn
        FROM d WHERE {value} <> {blank} GROUP BY 1, 2) WHERE rn <= 5 GROUP BY 1)"""

LOAN_CATALOG_SQL = f"""
WITH d AS (SELECT * FROM loans WHERE status IN {normalize.LOAN_INCLUDED} QUALIFY row_number() OVER (PARTITION BY acctno, type ORDER BY o_orderkey) = 1),
     base AS (SELECT type, count(*) AS account_count, arg_min(loantype, o_orderkey) AS sample FROM d GROUP BY 1)
SELECT type AS product_code, account_count, sample AS sample_loan_type_desc, p.dist AS purcod_distribution, q.dist AS purpose_distribution,
       coalesce(description, sample, '(unknown)') AS product_name, 'Loan' AS source_file
FROM base LEFT JOIN {JSON_SQL.format(value='purcod', blank='0')} p USING (type) LEFT JOIN {JSON_SQL.format(value='purpose', blank="''")} q USING (type)
LEFT JOIN loan_types ON code = type"""


@query("q_loan_catalog", v.with_views("loans loan_types", LOAN_CATALOG_SQL))
def q_loan_catalog(spark: SparkSession, sf: str) -> DataFrame:
    return catalogs.loan_catalog(v.loans(spark, sf), v.loan_types(spark, sf), ["o_orderkey"])


def product_catalog(spark: SparkSession, sf: str) -> DataFrame:
    truth = q_deposit_catalog(spark, sf).select(
        "product_code", *[F.lit("x").alias(c) for c in ("gt_L1_line_of_business", "gt_L2_type", "gt_L3_category", "gt_L4_subcategory", "gt_L5_special")]
    )
    return catalogs.combined_product_catalog([q_deposit_catalog(spark, sf), q_loan_catalog(spark, sf)], truth)


@query("q_product_catalog", v.with_views("loans loan_types deposits types", f"""
WITH loan AS ({LOAN_CATALOG_SQL}),
     dep AS (SELECT sccode AS product_code, count(*) AS account_count, coalesce(any_value(description), '(unknown)') AS product_name
             FROM deposits LEFT JOIN types ON code = sccode
             WHERE sccode IS NOT NULL AND CAST(status AS INTEGER) IN {normalize.DEPOSIT_INCLUDED} GROUP BY 1)
SELECT product_code, account_count, product_name, 'Deposit' AS source_file, NULL AS sample_loan_type_desc, NULL AS purcod_distribution,
       NULL AS purpose_distribution, 1 AS layer FROM dep
UNION ALL SELECT product_code, account_count, product_name, source_file, sample_loan_type_desc, purcod_distribution, purpose_distribution, 3 FROM loan"""))
def q_product_catalog(spark: SparkSession, sf: str) -> DataFrame:
    return product_catalog(spark, sf)


HISTORY_SQL = f"""
WITH dep AS (SELECT acctno, sccode AS code, coalesce(description, '(unknown)') AS descr, branch, opened,
                    {"CASE CAST(status AS INTEGER) " + " ".join(f"WHEN {k} THEN '{s}'" for k, s in normalize.DEPOSIT_STATES.items()) + " ELSE 'ACTIVE' END"} AS state,
                    CAST(NULL AS DOUBLE) AS rate
             FROM deposits LEFT JOIN types ON code = sccode),
     ln AS (SELECT acctno, type AS code, coalesce(nullif(loantype, 'nan'), description, '(unknown)') AS descr, branch, opened,
                   {"CASE status " + " ".join(f"WHEN {k} THEN '{s}'" for k, s in normalize.LOAN_STATES.items()) + " ELSE 'ACTIVE' END"} AS state, rate
            FROM (SELECT * FROM loans QUALIFY row_number() OVER (PARTITION BY acctno, type ORDER BY o_orderkey) = 1) LEFT JOIN loan_types ON code = type),
     a AS (SELECT * FROM dep UNION ALL SELECT * FROM ln)
SELECT acctno AS "AccountIdentifier", code AS "ProductInstanceReference", descr AS "ProductInstanceDescription", branch AS "BranchLocationReference",
       strftime(opened, '%Y-%m-%d') AS "AccountOpeningDate", state AS "AccountStatus", CAST(rate AS DOUBLE) AS "InterestRate"
FROM a"""
CAP_SQL = """ QUALIFY row_number() OVER (PARTITION BY code ORDER BY acctno, descr, state) <= 50"""


def _history(spark: SparkSession, sf: str, cap: int | None) -> DataFrame:
    as_of = F.lit("2026-01-01 00:00:00").cast("timestamp")
    rows = history_plan.account_history(
        history_plan.deposit_history(v.deposits(spark, sf), v.type_list(spark, sf), ["ACCTNO"], as_of),
        history_plan.loan_history(v.loans(spark, sf), v.loan_types(spark, sf), ["o_orderkey"], as_of),
        cap,
    )
    return rows.select(
        "AccountIdentifier", "ProductInstanceReference", "ProductInstanceDescription", "BranchLocationReference",
        F.date_format("AccountOpeningDate", "yyyy-MM-dd").alias("AccountOpeningDate"), "AccountStatus",
        F.col("InterestRate").cast("double").alias("InterestRate"),
    )


@query("q_account_history", v.with_views("deposits types loans loan_types", HISTORY_SQL))
def q_account_history(spark: SparkSession, sf: str) -> DataFrame:
    return _history(spark, sf, None)


@query("q_account_history_capped", v.with_views("deposits types loans loan_types", HISTORY_SQL + CAP_SQL))
def q_account_history_capped(spark: SparkSession, sf: str) -> DataFrame:
    return _history(spark, sf, history_plan.ROWS_PER_CODE)


@query("q_text_cleaning", """
SELECT doc_id, sha256(trim(regexp_replace(text, '\\s+', ' ', 'g'))) AS squeezed,
       sha256(replace(regexp_replace(text, '[\\x00-\\x1f\\x7f]', '', 'g'), '\\', '\\\\')) AS sanitized,
       regexp_replace(source || ' ' || lang, '[^a-zA-Z0-9_.-]', '_', 'g') AS safe_name,
       substr(sha256(upper(trim(source))), 1, 32) AS id, length(text) // 4 AS tokens
FROM documents""")
def q_text_cleaning(spark: SparkSession, sf: str) -> DataFrame:
    docs = v.table(spark, sf, "documents")
    return docs.select(
        "doc_id", F.sha2(text.squeeze("text"), 256).alias("squeezed"),
        F.sha2(text.sanitize_description("text"), 256).alias("sanitized"),
        text.sanitize_name(F.concat_ws(" ", "source", "lang")).alias("safe_name"),
        text.surrogate_id("source").alias("id"), text.estimate_tokens("text").alias("tokens"),
    )


@query("q_parse_values", """
SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 3 THEN NULL ELSE o_totalprice END AS amount,
       CASE WHEN o_orderkey % 3 = 2 THEN NULL ELSE strftime(o_orderdate, '%Y-%m-%d') END AS opened
FROM orders""")
def q_parse_values(spark: SparkSession, sf: str) -> DataFrame:
    key = F.col("o_orderkey")
    raw = v.table(spark, sf, "orders").select(
        "o_orderkey",
        F.when(key % 4 == 3, "n/a").otherwise(F.concat(F.lit(" "), F.col("o_totalprice").cast("string"))).alias("amount"),
        F.when(key % 3 == 0, F.date_format("o_orderdate", "MM/dd/yyyy")).when(key % 3 == 1, F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"))
        .otherwise("31.31.2020").alias("opened"),
    )
    opened = F.date_format(parse.to_date_mixed("opened"), "yyyy-MM-dd")
    return raw.select("o_orderkey", parse.to_number("amount").alias("amount"), opened.alias("opened"))


PROFILE_SQL = """
WITH h AS (SELECT event_id, CAST(user_id AS VARCHAR) AS "TRANCD", event_type AS "EFHDS1", CAST(value AS VARCHAR) AS "AMT",
                  strftime(ts, '%Y-%m-%d') AS "TRDATE", '' AS description FROM events),
     u AS (SELECT event_id, col AS "column", value AS x FROM (UNPIVOT (SELECT * FROM h) ON "TRANCD", "EFHDS1", "AMT", "TRDATE", description INTO NAME col VALUE value) WHERE value <> ''),
     s AS (SELECT "column", bool_or(contains(x, '-') AND length(x) = 10) AS dated, bool_and(regexp_full_match(replace(replace(x, '.', ''), '-', ''), '[0-9]+')) AS numbers,
                  bool_or(contains(x, '.')) AS dotted, max(length(x)) AS longest, array_to_string((array_agg(x ORDER BY event_id))[1:5], ' | ') AS samples FROM u GROUP BY 1)
SELECT n."column", CASE WHEN s."column" IS NULL THEN 'empty' WHEN dated THEN 'dates (YYYY-MM-DD)' WHEN NOT numbers THEN 'text' WHEN dotted THEN 'decimal numbers'
                        WHEN longest <= 3 THEN 'small integers' ELSE 'integers' END AS kind, coalesce(samples, '') AS samples
FROM (VALUES ('TRANCD'), ('EFHDS1'), ('AMT'), ('TRDATE'), ('description')) n("column") LEFT JOIN s ON n."column" = s."column" """


def _unknown_extract(spark: SparkSession, sf: str) -> DataFrame:
    return v.table(spark, sf, "events").select(
        "event_id", F.col("user_id").cast("string").alias("TRANCD"), F.col("event_type").alias("EFHDS1"),
        F.col("value").cast("string").alias("AMT"), F.date_format("ts", "yyyy-MM-dd").alias("TRDATE"), F.lit("").alias("description"),
    )


@query("q_column_profile", PROFILE_SQL)
def q_column_profile(spark: SparkSession, sf: str) -> DataFrame:
    return profile.profile_columns(_unknown_extract(spark, sf), "event_id")


@query("q_column_map", f"""
WITH p AS ({PROFILE_SQL})
SELECT "column" AS client_column, CASE "column" WHEN 'TRANCD' THEN 'transaction_code' WHEN 'EFHDS1' THEN 'description_1' ELSE 'transaction_desc' END AS canonical_column,
       CASE WHEN "column" = 'TRANCD' AND kind IN ('small integers', 'integers') OR "column" = 'EFHDS1' AND kind = 'text'
              OR "column" = 'description' AND kind IN ('text', 'empty') THEN 3 ELSE 2 END AS score
FROM p WHERE "column" IN ('TRANCD', 'EFHDS1', 'description')""")
def q_column_map(spark: SparkSession, sf: str) -> DataFrame:
    return profile.map_columns(q_column_profile(spark, sf))
