"""Queries that write tables to files and read them back, and the prompt lines of products and suggestions."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from codeloom.operators import batching, closure, taxonomy
from codeloom.plans.uncategorized import uncategorized_catalog
from codeloom.registry import views as v
from codeloom.registry.catalog_queries import LOAN_CATALOG_SQL, product_catalog
from codeloom.registry.classification_queries import UNCATEGORIZED_SQL
from codeloom.registry.views import with_views
from codeloom.session import work_dir
from codeloom.sources import delimited, documents, ragged, tables

Query = tuple[Callable[[SparkSession, str], DataFrame], str | None]
QUERIES: dict[str, Query] = {}


def query(name: str, sql: str | None = None):
    def register(build):
        QUERIES[name] = (build, sql)
        return build

    return register


def _write_csv(df: DataFrame, path: str, header: bool) -> None:
    df.write.option("header", header).option("escape", '"').option("encoding", delimited.ENCODING).csv(path)


@query("q_headed_files", """
SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, CAST(c_nationkey AS VARCHAR) AS c_nationkey, CASE WHEN c_custkey % 2 = 0 THEN c_name END AS c_name,
       CASE WHEN c_custkey % 2 = 1 THEN c_mktsegment END AS c_mktsegment FROM customer""")
def q_headed_files(spark: SparkSession, sf: str) -> DataFrame:
    """Files that order their columns differently and lack some, stacked by name."""
    folder = work_dir(spark, "headed")
    customer = v.table(spark, sf, "customer")
    _write_csv(customer.filter("c_custkey % 2 = 0").select("c_custkey", "c_name", "c_nationkey"), f"{folder}/a", True)
    _write_csv(customer.filter("c_custkey % 2 = 1").select("c_mktsegment", "c_nationkey", "c_custkey"), f"{folder}/b", True)
    return delimited.read_headed(spark, f"{folder}/*/*.csv", ["c_custkey", "c_nationkey", "c_name", "c_mktsegment"])


@query("q_positional_sheet", """
SELECT CAST(s_suppkey AS VARCHAR) AS c0, s_name || ', "x"' AS c1, CASE WHEN s_suppkey % 3 > 0 THEN CAST(s_nationkey AS VARCHAR) END AS c2 FROM supplier""")
def q_positional_sheet(spark: SparkSession, sf: str) -> DataFrame:
    """A headerless sheet with quoted commas, doubled quotes and null tokens."""
    folder = work_dir(spark, "sheet")
    rows = v.table(spark, sf, "supplier").select(
        "s_suppkey", F.concat("s_name", F.lit(', "x"')), F.when(F.col("s_suppkey") % 3 == 0, "N/A").otherwise(F.col("s_nationkey").cast("string"))
    )
    _write_csv(rows, folder, False)
    return delimited.read_positional(spark, folder, 3).select("c0", "c1", "c2")


@query("q_ragged_multiline", """
SELECT CAST(conv_id AS VARCHAR) AS "A", CAST(turn AS VARCHAR) AS "B", sha256(text) AS "DESC1", role AS "END" FROM conversations""")
def q_ragged_multiline(spark: SparkSession, sf: str) -> DataFrame:
    """Records whose quoted descriptions hold commas, quotes and line breaks."""
    folder = work_dir(spark, "records")
    quoted = F.concat(F.lit('"'), F.replace("text", F.lit('"'), F.lit('""')), F.lit('"'))
    v.table(spark, sf, "conversations").select(
        F.concat_ws(",", F.col("conv_id").cast("string"), F.col("turn").cast("string"), *[F.lit(x) for x in "cdef"], quoted, F.lit("x"), "role")
    ).write.text(folder)
    rows, _ = ragged.read_ragged(spark, folder, ["A", "B", "C", "D", "E", "F", "DESC1", "DESC2", "END"], multiline=True)
    return rows.select("A", "B", F.sha2("DESC1", 256).alias("DESC1"), "END")


def _versions(spark: SparkSession, sf: str, version: str, offset: int) -> DataFrame:
    return v.table(spark, sf, "supplier").select("s_suppkey", (F.col("s_nationkey") + offset).alias("value"), F.lit(version).alias("prompt_version"))


@query("q_version_overwrite", """
SELECT s_suppkey, s_nationkey + 7 AS value, 'v1' AS prompt_version FROM supplier WHERE s_suppkey % 2 = 0
UNION ALL SELECT s_suppkey, s_nationkey + 1, 'v2' FROM supplier""")
def q_version_overwrite(spark: SparkSession, sf: str) -> DataFrame:
    """A run replaces its own version and leaves the others; a version is read alone."""
    path = work_dir(spark, "results")
    tables.save_results(_versions(spark, sf, "v1", 0), path)
    tables.save_results(_versions(spark, sf, "v2", 1), path)
    tables.save_results(_versions(spark, sf, "v1", 7).filter("s_suppkey % 2 = 0"), path)
    return tables.load_version(spark, path, "v1").unionByName(tables.load_version(spark, path, "v2"))


@query("q_export_csv", "SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, p_name, nullif(p_brand, 'Brand#11') AS p_brand FROM part")
def q_export_csv(spark: SparkSession, sf: str) -> DataFrame:
    """An export reads back as it was, nulls included."""
    path = work_dir(spark, "export")
    tables.export_csv(v.table(spark, sf, "part").select("p_partkey", "p_name", F.nullif("p_brand", F.lit("Brand#11")).alias("p_brand")), path)
    return delimited.read_headed(spark, f"{path}/*.csv")


@query("q_insert_nulls", """
SELECT s_suppkey, CASE WHEN s_suppkey % 4 > 0 THEN s_name END AS s_name, s_acctbal FROM supplier""")
def q_insert_nulls(spark: SparkSession, sf: str) -> DataFrame:
    """A typed empty table filled by an insert that turns null tokens into nulls."""
    # Every fourth row has one of the tokens, each in turn.
    token = F.element_at(F.array(*map(F.lit, tables.INSERT_NULLS)), (F.expr("s_suppkey div 4") % len(tables.INSERT_NULLS) + 1).cast("int"))
    rows = v.table(spark, sf, "supplier").select(
        "s_suppkey", F.when(F.col("s_suppkey") % 4 == 0, token)
        .otherwise(F.col("s_name")).alias("s_name"), "s_acctbal",
    )
    name = f"codeloom_inserted_{uuid.uuid4().hex}"
    tables.create_table(spark, name, tables.empty(spark, rows.schema).schema)
    tables.append(rows, name)
    return tables.load(spark, name)


@query("q_taxonomy_document", "SELECT r_name AS l1, n_name AS l2 FROM region JOIN nation ON r_regionkey = n_regionkey")
def q_taxonomy_document(spark: SparkSession, sf: str) -> DataFrame:
    """Regions as blocks and nations as the level below, written as a document and read back as paths."""
    path = work_dir(spark, "document")
    region, nation = v.table(spark, sf, "region"), v.table(spark, sf, "nation")
    heads = region.select("r_regionkey", F.lit(-1).cast("bigint").alias("at"), F.concat(F.lit("## Block A — "), "r_name").alias("value"))
    below = nation.select(F.col("n_regionkey").alias("r_regionkey"), F.col("n_nationkey").alias("at"), F.concat(F.lit("### Level 2: "), "n_name").alias("value"))
    # One document is one file in order; it has a line per region and nation.
    heads.unionByName(below).repartition(1).sortWithinPartitions("r_regionkey", "at").select("value").write.text(path)
    return taxonomy.document_paths(documents.read_document(spark, path)).select("l1", "l2").filter("l2 is not null").distinct()


def _tree_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Places down to orders, parts by division of their numbers, and suppliers that name one another or nobody."""
    def rows(name: str, node: str, parent: str, label: str) -> DataFrame:
        return v.table(spark, sf, name).selectExpr(f"{node} as node", f"{parent} as parent", f"{label} as label")

    return (
        rows("region", "concat('R', r_regionkey)", "cast(null as string)", "r_name")
        .unionByName(rows("nation", "concat('N', n_nationkey)", "concat('R', n_regionkey)", "n_name"))
        .unionByName(rows("customer", "concat('C', c_custkey)", "concat('N', c_nationkey)", "c_name"))
        .unionByName(rows("orders", "concat('O', o_orderkey)", "concat('C', o_custkey)", "o_orderstatus"))
        .unionByName(rows("part", "concat('P', p_partkey)", "case when p_partkey >= 3 then concat('P', p_partkey div 3) end", "p_brand"))
        .unionByName(rows("supplier", "concat('S', s_suppkey)", "concat('S', if(s_suppkey % 4 < 2, s_suppkey ^ 1, -s_suppkey))", "s_name"))
    )


@query("q_taxonomy_closure", """
WITH RECURSIVE e AS (
  SELECT 'R' || r_regionkey AS node, CAST(NULL AS VARCHAR) AS parent, r_name AS label FROM region
  UNION ALL SELECT 'N' || n_nationkey, 'R' || n_regionkey, n_name FROM nation
  UNION ALL SELECT 'C' || c_custkey, 'N' || c_nationkey, c_name FROM customer
  UNION ALL SELECT 'O' || o_orderkey, 'C' || o_custkey, o_orderstatus FROM orders
  UNION ALL SELECT 'P' || p_partkey, CASE WHEN p_partkey >= 3 THEN 'P' || (p_partkey // 3) END, p_brand FROM part
  UNION ALL SELECT 'S' || s_suppkey, 'S' || CASE WHEN s_suppkey % 4 < 2 THEN xor(s_suppkey, 1) ELSE -s_suppkey END, s_name FROM supplier),
w AS (
  SELECT node, label AS path, 0 AS depth, CASE WHEN parent IS NOT NULL THEN 'orphan' END AS fault FROM e
  WHERE parent IS NULL OR parent NOT IN (SELECT node FROM e)
  UNION ALL SELECT e.node, w.path || ' > ' || e.label, w.depth + 1, w.fault FROM e JOIN w ON e.parent = w.node)
SELECT node, path, depth, fault FROM w UNION ALL SELECT node, NULL, NULL, 'cycle' FROM e WHERE node NOT IN (SELECT node FROM w)""")
def q_taxonomy_closure(spark: SparkSession, sf: str) -> DataFrame:
    """Paths of a tree kept as parent-child rows, with its orphans and cycles."""
    return closure.closure(_tree_rows(spark, sf)).withColumn("path", F.array_join("path", " > "))


def _lines(catalog: DataFrame, line: Column) -> DataFrame:
    return catalog.select("product_code", line.alias("line"))


@query("q_product_prompts", with_views("loans loan_types", f"""
WITH c AS ({LOAN_CATALOG_SQL})
SELECT product_code, 'product_code=' || product_code || ', DESC="' || CASE WHEN trim(product_name) IN ('nan', '', 'None', '(unknown)') THEN '(no description)' ELSE trim(product_name) END
  || '", DOMAIN=Loan' || coalesce(', PURCOD_DIST=' || purcod_distribution, '') || coalesce(', PURPOSE_DIST=' || purpose_distribution, '') AS line FROM c"""))
def q_product_prompts(spark: SparkSession, sf: str) -> DataFrame:
    """The prompt line of every loan code, with its two distributions."""
    return _lines(product_catalog(spark, sf).filter("source_file = 'Loan'"), batching.product_line())


@query("q_suggestion_prompts", with_views("ah master", f"""WITH {UNCATEGORIZED_SQL.strip()}
SELECT product_code, 'product_code=' || product_code || ', SAMPLES="' || replace(trim(samples), '\\', '\\\\') || '", VOLUME=' || volume AS line FROM c"""))
def q_suggestion_prompts(spark: SparkSession, sf: str) -> DataFrame:
    """The prompt line of every uncategorized code, with all its samples."""
    return _lines(uncategorized_catalog(v.history(spark, sf), v.master(spark, sf)), batching.suggestion_line())
