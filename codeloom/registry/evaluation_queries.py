"""Queries over predictions and truth."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from codeloom.functions.levels import PRODUCT, TRANSACTION, VALID_LOB, level_matches, match_strict
from codeloom.functions.text import path_label
from codeloom.operators import audits, evaluation, inference, matching, ordering, taxonomy, versions
from codeloom.registry import views as v
from codeloom.session import settle, work_dir
from codeloom.sources import tables
from codeloom.registry.views import canon_sql, lenient_sql, strict_sql, with_views

Query = tuple[Callable[[SparkSession, str], DataFrame], str | None]
QUERIES: dict[str, Query] = {}
ORDER = ["p_partkey"]
FLAGS = [*[f"match_L{i}" for i in range(1, 5)], "partial_match_L1L2", "partial_match_L1L2L3", "exact_match"]


def query(name: str, sql: str | None = None):
    def register(build):
        QUERIES[name] = (build, sql)
        return build

    return register


# --- SQL fragments ------------------------------------------------------------------------------------------

M = [lenient_sql(f"category_{i}", f'"gt_L{i}"') for i in range(1, 5)]
MATCH_SQL = ", ".join(f'{m} AS "match_L{i + 1}"' for i, m in enumerate(M))
L1_SQL = f"""
l1 AS (SELECT *, "match_L1" AND "match_L2" AS "partial_match_L1L2", "match_L1" AND "match_L2" AND "match_L3" AS "partial_match_L1L2L3",
              "match_L1" AND "match_L2" AND "match_L3" AND "match_L4" AS exact_match
       FROM (SELECT p.*, s.gt_desc, s."gt_L1", s."gt_L2", s."gt_L3", s."gt_L4", {MATCH_SQL}
             FROM pred p LEFT JOIN gt_single s USING (transaction_code) WHERE layer = 1))"""
ANY = [strict_sql(f"category_{i}", f'"gt_L{i}"') for i in range(1, 5)]
L2_SQL = f"""
l2 AS (SELECT prompt_version, transaction_code, any_value(category_1) AS category_1, any_value(category_2) AS category_2,
              any_value(category_3) AS category_3, any_value(volume) AS volume, any_value(confidence) AS confidence,
              coalesce(bool_or({' AND '.join(ANY)}), false) AS exact_match_any,
              coalesce(max({' + '.join(f'CAST({a} AS INTEGER)' for a in ANY)}), 0) AS best_levels_matched
       FROM pred p LEFT JOIN gt USING (transaction_code) WHERE layer = 2 GROUP BY 1, 2)"""
MISS_SQL = (
    "CASE WHEN NOT \"match_L1\" THEN 'WRONG BLOCK (L1)' WHEN NOT \"match_L2\" THEN 'WRONG CATEGORY (L2)' "
    "WHEN NOT \"match_L3\" THEN 'WRONG CHANNEL (L3)' WHEN NOT \"match_L4\" THEN 'WRONG SUBTYPE (L4)' END"
)


def _rates_sql(flags: list[str], weight: str) -> str:
    out = []
    for f in flags:
        out.append(f'round(avg(CAST("{f}" AS DOUBLE)), 6) AS "{f}"')
        out.append(
            f'round(coalesce(sum(CASE WHEN "{f}" THEN {weight} END), 0)::DOUBLE / greatest(coalesce(sum({weight}), 0), 1), 6) AS "w_{f}"'
        )
    return ", ".join(out)


def as_text(frame: DataFrame) -> DataFrame:
    """Verdicts as text: true, false or null."""
    return frame.select(*[F.col(c).cast("string").alias(c) if t == "boolean" else F.col(c) for c, t in frame.dtypes])


def layer_one(spark: SparkSession, sf: str) -> DataFrame:
    return evaluation.layer_one(
        v.predictions(spark, sf), v.truth(spark, sf), TRANSACTION, "transaction_code", ["gt_desc"], ORDER
    )


def evaluated(spark: SparkSession, sf: str) -> DataFrame:
    return evaluation.evaluate(
        settle(v.predictions(spark, sf)), v.truth(spark, sf), TRANSACTION, "transaction_code", ["gt_desc"], ORDER
    )


@query("q_eval_l1", with_views("pred gt_single", f"""WITH {L1_SQL.strip()}
SELECT prompt_version, transaction_code, gt_desc, "match_L1", "match_L2", "match_L3", "match_L4", "partial_match_L1L2", "partial_match_L1L2L3", exact_match FROM l1"""))
def q_eval_l1(spark: SparkSession, sf: str) -> DataFrame:
    return layer_one(spark, sf).select("prompt_version", "transaction_code", "gt_desc", *FLAGS)


# Buckets of the stored predictions and truths; both have the same number, so that they join bucket by bucket.
BUCKETS = 8


def _bucketed(df: DataFrame, label: str) -> DataFrame:
    name = f"codeloom_{label}_{uuid.uuid4().hex}"
    tables.save_bucketed(df, name, "transaction_code", BUCKETS, work_dir(df.sparkSession, label))
    return tables.load(df.sparkSession, name)


@query("q_eval_bucketed", with_views("pred gt_single", f"""WITH {L1_SQL.strip()}
SELECT prompt_version, count(*) AS codes, CAST(sum(volume) AS BIGINT) AS weight, {_rates_sql(FLAGS, 'volume')} FROM l1 GROUP BY 1"""))
def q_eval_bucketed(spark: SparkSession, sf: str) -> DataFrame:
    """Accuracy by version from tables bucketed by code: only the figures of each version are moved."""
    pred, truth = _bucketed(v.predictions(spark, sf), "pred"), _bucketed(v.truth(spark, sf), "truth")
    matched = evaluation.layer_one(pred, truth, TRANSACTION, "transaction_code", ["gt_desc"], ORDER)
    return evaluation.accuracy(matched, FLAGS, "volume", ["prompt_version"])


@query("q_eval_l1_weighted", with_views("pred gt_single", f"""WITH {L1_SQL.strip()}
SELECT prompt_version, count(*) AS codes, CAST(sum(volume) AS BIGINT) AS weight, {_rates_sql(FLAGS, 'volume')} FROM l1 GROUP BY 1"""))
def q_eval_l1_weighted(spark: SparkSession, sf: str) -> DataFrame:
    return evaluation.accuracy(layer_one(spark, sf), FLAGS, "volume", ["prompt_version"])


@query("q_eval_l2_strict", with_views("pred gt gt_counts", f"""WITH {L2_SQL.strip()}
SELECT prompt_version, transaction_code, volume, coalesce(category_1, 'None') || ' > ' || coalesce(category_2, 'None') || ' > ' || coalesce(category_3, 'None') AS llm_path,
       exact_match_any, best_levels_matched, n_mappings AS n_valid_mappings, confidence
FROM l2 LEFT JOIN gt_counts USING (transaction_code)"""))
def q_eval_l2_strict(spark: SparkSession, sf: str) -> DataFrame:
    pred = settle(v.predictions(spark, sf).filter(F.col("layer") == 2))
    truth = v.truth(spark, sf)
    best = matching.with_agreement(pred, truth, TRANSACTION, "transaction_code")
    counts = truth.groupBy("transaction_code").agg(F.count_distinct(F.struct(*TRANSACTION.truth)).alias("n_valid_mappings"))
    return best.join(counts, "transaction_code", "left").select(
        "prompt_version", "transaction_code", "volume", path_label(*TRANSACTION.pred[:3]).alias("llm_path"),
        "exact_match_any", "best_levels_matched", "n_valid_mappings", "confidence",
    )


P = [lenient_sql(f"c{i}", f"g{i}") for i in range(1, 6)]


@query("q_eval_l2_lenient", with_views("ppred pgt", f"""
SELECT product_code, any_value(account_count) AS account_count,
       coalesce(bool_or({' AND '.join(P[:3])}) FILTER (g2 IS NOT NULL), false) AS canonical_match_any,
       coalesce(bool_or({' AND '.join(P)}) FILTER (g2 IS NOT NULL), false) AS full_match_any,
       coalesce(max({' + '.join(f'CAST({p} AS INTEGER)' for p in P[:3])}) FILTER (g2 IS NOT NULL), 0) AS best_canonical_matched
FROM ppred LEFT JOIN pgt USING (product_code) WHERE layer = 2 GROUP BY 1"""))
def q_eval_l2_lenient(spark: SparkSession, sf: str) -> DataFrame:
    pred = settle(v.product_predictions(spark, sf).filter(F.col("layer") == 2))
    truth = matching.supported_lob(v.product_truth_rows(spark, sf), "gt_L1_line_of_business", VALID_LOB)
    best = matching.with_agreement(pred, truth, PRODUCT, "product_code")
    return best.select(
        "product_code", "account_count", F.col("exact_match_any").alias("canonical_match_any"), "full_match_any",
        F.col("best_levels_matched").alias("best_canonical_matched"),
    )


PRODUCT_EVAL_SQL = f"""
WITH one AS (SELECT p.*, s.g1, s.g2, s.g3, s.g4, s.g5, k.n,
                    {', '.join(f'{p.replace("(g", "(s.g")} AS m{i + 1}' for i, p in enumerate(P))}
             FROM ppred p LEFT JOIN pgt_single s USING (product_code) LEFT JOIN pgt_counts k USING (product_code) WHERE layer = 1),
     two AS (SELECT product_code, coalesce(bool_or({' AND '.join(P[:3])}) FILTER (g2 IS NOT NULL), false) AS can,
                    coalesce(bool_or({' AND '.join(P)}) FILTER (g2 IS NOT NULL), false) AS ful
             FROM ppred LEFT JOIN pgt USING (product_code) WHERE layer = 2 GROUP BY 1)
SELECT product_code, layer, g1, m1 AS "match_L1", m2 AS "match_L2", m3 AS "match_L3", m4 AS "match_L4", m5 AS "match_L5",
       m1 AND m2 AND m3 AS canonical_match, m1 AND m2 AND m3 AND m4 AND m5 AS full_match, m1 AND m2 AND m3 AS exact_match,
       CASE WHEN NOT m1 THEN 'WRONG LOB (L1)' WHEN NOT m2 THEN 'WRONG TYPE (L2)' WHEN NOT m3 THEN 'WRONG CATEGORY (L3)'
            WHEN NOT m4 AND NOT m5 THEN 'MISMATCH L4+L5' WHEN NOT m4 THEN 'MISMATCH L4' WHEN NOT m5 THEN 'MISMATCH L5' END AS failure_type,
       'EVALUATED' AS review_status
FROM one WHERE n IS NOT NULL AND NOT (g1 IS NULL AND g2 IS NULL)
UNION ALL SELECT product_code, layer, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, 'GT_LOB_EXCLUDED', 'GT_LOB_EXCLUDED' FROM one WHERE n IS NULL
UNION ALL SELECT product_code, 2, NULL, NULL, NULL, NULL, NULL, NULL, can, ful, can, CASE WHEN NOT can THEN 'AMBIGUOUS_NO_CANONICAL_MATCH' END, 'EVALUATED' FROM two
UNION ALL SELECT product_code, layer, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, 'NEEDS MANUAL REVIEW' FROM ppred WHERE layer = 3"""


def evaluated_products(spark: SparkSession, sf: str) -> DataFrame:
    truth = matching.supported_lob(v.product_truth_rows(spark, sf), "gt_L1_line_of_business", VALID_LOB)
    return evaluation.evaluate(
        settle(v.product_predictions(spark, sf)), truth, PRODUCT, "product_code", ["truth_name"], ORDER, exclude_missing=True,
    )


def _text_sql(body: str, flags: list[str]) -> str:
    """The last SELECT of ``body`` with its flags as text."""
    shown = ", ".join(f'CAST("{f}" AS VARCHAR) AS "{f}"' for f in flags)
    return f"SELECT * REPLACE ({shown}) FROM ({body})"


PRODUCT_VERDICTS = [*[f"match_L{i}" for i in range(1, 6)], "canonical_match", "full_match", "exact_match"]


@query("q_eval_products", _text_sql(with_views("ppred pgt_single pgt_counts", PRODUCT_EVAL_SQL), PRODUCT_VERDICTS))
def q_eval_products(spark: SparkSession, sf: str) -> DataFrame:
    return as_text(evaluated_products(spark, sf).select(
        "product_code", "layer", F.col("gt_L1_line_of_business").alias("g1"), *[f"match_L{i}" for i in range(1, 6)],
        "canonical_match", "full_match", "exact_match", "failure_type", "review_status",
    ))


@query("q_excluded_truth", with_views("pgt_all", """
SELECT DISTINCT product_code, g1 AS lob FROM pgt_all WHERE lower(trim(g1)) NOT IN ('retail', 'business')"""))
def q_excluded_truth(spark: SparkSession, sf: str) -> DataFrame:
    gone = matching.unsupported_lob(v.product_truth_rows(spark, sf), "gt_L1_line_of_business", VALID_LOB)
    return gone.select("product_code", F.col("gt_L1_line_of_business").alias("lob")).distinct()


PRODUCT_FLAGS = [*[f"match_L{i}" for i in range(1, 6)], "partial_match_L1L2", "canonical_match", "full_match"]


@query("q_eval_products_weighted", with_views("ppred pgt_single", f"""
WITH one AS (SELECT p.account_count, {', '.join(f'{p.replace("(g", "(s.g")} AS "match_L{i + 1}"' for i, p in enumerate(P))}
             FROM ppred p JOIN pgt_single s USING (product_code) WHERE layer = 1 AND NOT (g1 IS NULL AND g2 IS NULL)),
     f AS (SELECT *, "match_L1" AND "match_L2" AS "partial_match_L1L2", "match_L1" AND "match_L2" AND "match_L3" AS canonical_match,
                  "match_L1" AND "match_L2" AND "match_L3" AND "match_L4" AND "match_L5" AS full_match FROM one)
SELECT count(*) AS codes, CAST(coalesce(sum(account_count), 0) AS BIGINT) AS weight, {_rates_sql(PRODUCT_FLAGS, 'account_count')} FROM f"""))
def q_eval_products_weighted(spark: SparkSession, sf: str) -> DataFrame:
    truth = matching.supported_lob(v.product_truth_rows(spark, sf), "gt_L1_line_of_business", VALID_LOB)
    frame = evaluation.layer_one(
        v.product_predictions(spark, sf), truth, PRODUCT, "product_code", ["truth_name"], ORDER, drop_excluded=True
    )
    return evaluation.accuracy(frame, PRODUCT_FLAGS, "account_count")


EVAL_TABLE_SQL = f"""
SELECT prompt_version, transaction_code, layer, volume, "gt_L1", "match_L1", "match_L2", "match_L3", "match_L4", exact_match,
       "partial_match_L1L2", "partial_match_L1L2L3", {MISS_SQL} AS failure_type, 'EVALUATED' AS review_status FROM l1
UNION ALL SELECT prompt_version, transaction_code, 2, volume, NULL, NULL, NULL, NULL, NULL, exact_match_any, NULL, NULL,
       CASE WHEN NOT exact_match_any THEN 'AMBIGUOUS_NO_MATCH' END, 'EVALUATED' FROM l2
UNION ALL SELECT prompt_version, transaction_code, 3, volume, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, 'NEEDS MANUAL REVIEW' FROM pred WHERE layer = 3"""


@query("q_eval_table", _text_sql(with_views("pred gt gt_single", f"WITH {L1_SQL.strip()},{L2_SQL}{EVAL_TABLE_SQL}"), FLAGS))
def q_eval_table(spark: SparkSession, sf: str) -> DataFrame:
    return as_text(evaluated(spark, sf).select(
        "prompt_version", "transaction_code", "layer", "volume", "gt_L1", *FLAGS, "failure_type", "review_status"
    ))


@query("q_review_counts", with_views("pred", """
SELECT CASE WHEN layer = 3 THEN 'NEEDS MANUAL REVIEW' ELSE 'EVALUATED' END AS review_status, layer, count(*) AS count FROM pred GROUP BY 1, 2"""))
def q_review_counts(spark: SparkSession, sf: str) -> DataFrame:
    return evaluated(spark, sf).groupBy("review_status", "layer").agg(F.count("*").alias("count"))


@query("q_failures", with_views("pred gt gt_single", f"""WITH {L1_SQL.strip()},{L2_SQL},
e AS ({EVAL_TABLE_SQL}), f AS (SELECT * FROM e WHERE failure_type IS NOT NULL),
d AS (SELECT failure_type, transaction_code, row_number() OVER (PARTITION BY failure_type ORDER BY transaction_code) AS rn
      FROM (SELECT DISTINCT failure_type, transaction_code FROM f))
SELECT f.failure_type, count(*) AS count, CAST(sum(volume) AS BIGINT) AS weight,
       any_value(s.examples) AS examples
FROM f JOIN (SELECT failure_type, string_agg(transaction_code, ', ' ORDER BY transaction_code) AS examples FROM d WHERE rn <= 4 GROUP BY 1) s
USING (failure_type) GROUP BY 1"""))
def q_failures(spark: SparkSession, sf: str) -> DataFrame:
    return evaluation.failure_distribution(evaluated(spark, sf), "transaction_code", "volume")


@query("q_mismatch_long", with_views("pred gt_single", f"""WITH {L1_SQL.strip()}
{' UNION ALL '.join(f'''SELECT transaction_code, prompt_version, volume, 'L{i}' AS level, category_{i} AS predicted, "gt_L{i}" AS expected FROM l1 WHERE NOT "match_L{i}"''' for i in range(1, 5))}"""))
def q_mismatch_long(spark: SparkSession, sf: str) -> DataFrame:
    return evaluation.mismatches(layer_one(spark, sf), TRANSACTION, "transaction_code", ["prompt_version", "volume"])


@query("q_valid_mappings", with_views("pred gt", """
SELECT DISTINCT transaction_code, gt_desc, "gt_L1", "gt_L2", "gt_L3" FROM gt WHERE transaction_code IN (SELECT transaction_code FROM pred WHERE layer = 2)"""))
def q_valid_mappings(spark: SparkSession, sf: str) -> DataFrame:
    ambiguous = v.predictions(spark, sf).filter(F.col("layer") == 2)
    return matching.valid_mappings(ambiguous, v.truth(spark, sf), "transaction_code", ["gt_desc", "gt_L1", "gt_L2", "gt_L3"])


@query("q_unknown_codes", with_views("pred", "SELECT prompt_version, transaction_code, volume, confidence FROM pred WHERE layer = 3"))
def q_unknown_codes(spark: SparkSession, sf: str) -> DataFrame:
    unknown = v.predictions(spark, sf).filter(F.col("layer") == 3)
    return unknown.orderBy(F.desc("volume"), "transaction_code").select("prompt_version", "transaction_code", "volume", "confidence")


VERSION_FLAGS = ["match_L1", "match_L2", "match_L3", "match_L4", "partial_match_L1L2", "exact_match"]


@query("q_version_compare", with_views("pred gt_single", f"""WITH {L1_SQL.strip()},
b AS (SELECT prompt_version, batch_id, count(*) AS codes, max(estimated_cost) AS cost FROM pred GROUP BY 1, 2),
t AS (SELECT prompt_version, CAST(sum(codes) AS BIGINT) AS codes, round(sum(cost), 6) AS estimated_cost FROM b GROUP BY 1),
s AS (SELECT prompt_version, count(*) AS l1_codes, {_rates_sql(VERSION_FLAGS, 'volume')} FROM l1 GROUP BY 1)
SELECT *, round("w_exact_match" - lag("w_exact_match") OVER (ORDER BY prompt_version), 6) AS delta_w_exact_match,
       round("w_partial_match_L1L2" - lag("w_partial_match_L1L2") OVER (ORDER BY prompt_version), 6) AS "delta_w_partial_match_L1L2",
       round(estimated_cost - lag(estimated_cost) OVER (ORDER BY prompt_version), 6) AS delta_cost
FROM t LEFT JOIN s USING (prompt_version)"""))
def q_version_compare(spark: SparkSession, sf: str) -> DataFrame:
    results = settle(v.predictions(spark, sf))
    matched = evaluation.layer_one(results, v.truth(spark, sf), TRANSACTION, "transaction_code", ["gt_desc"], ORDER)
    return versions.compare_versions(
        results, matched, VERSION_FLAGS, "volume", ["exact_match", "partial_match_L1L2"]
    )


@query("q_version_list", with_views("pred", "SELECT DISTINCT prompt_version FROM pred"))
def q_version_list(spark: SparkSession, sf: str) -> DataFrame:
    return versions.versions(v.predictions(spark, sf))


@query("q_latest_version", with_views("pred", """
SELECT transaction_code, category_1, confidence FROM pred WHERE prompt_version = (SELECT max(prompt_version) FROM pred)"""))
def q_latest_version(spark: SparkSession, sf: str) -> DataFrame:
    return versions.of_version(settle(v.predictions(spark, sf))).select("transaction_code", "category_1", "confidence")


KPI_FLAGS = ["match_L1", "match_L2", "match_L3", "match_L4", "partial_match_L1L2", "exact_match"]


@query("q_kpi", with_views("pred gt gt_single", f"""WITH {L1_SQL.strip()},{L2_SQL},
e AS ({EVAL_TABLE_SQL}),
k AS (SELECT count(*) AS codes, CAST(sum(volume) AS BIGINT) AS total_weight, count(*) FILTER (layer = 1) AS l1_codes,
             CAST(coalesce(sum(volume) FILTER (layer = 1), 0) AS BIGINT) AS l1_weight, count(*) FILTER (layer = 2) AS l2_codes,
             count(*) FILTER (layer = 3) AS l3_codes, coalesce(round(avg(CAST(exact_match AS DOUBLE)) FILTER (layer = 2), 6), 0.0::DOUBLE) AS l2_any_match,
             {', '.join(f'round(avg(CAST("{f}" AS DOUBLE)) FILTER (layer = 1), 6) AS "{f}"' for f in KPI_FLAGS)},
             {', '.join(f'round(coalesce(sum(volume) FILTER (layer = 1 AND "{f}"), 0)::DOUBLE / greatest(sum(volume) FILTER (layer = 1), 1), 6) AS "w_{f}"' for f in KPI_FLAGS[4:])}
      FROM e)
SELECT *, CASE WHEN "w_exact_match" >= 0.8 THEN 'MET' ELSE 'BELOW TARGET' END AS target FROM k"""))
def q_kpi(spark: SparkSession, sf: str) -> DataFrame:
    return evaluation.kpi(evaluated(spark, sf), TRANSACTION, "volume")


PRODUCT_KPI_FLAGS = [*[f"match_L{i}" for i in range(1, 6)], "partial_match_L1L2", "exact_match", "full_match"]


@query("q_kpi_products", with_views("ppred pgt_single pgt_counts", f"""
WITH one AS (SELECT p.account_count, {', '.join(f'{p.replace("(g", "(s.g")} AS "match_L{i + 1}"' for i, p in enumerate(P))}
             FROM ppred p JOIN pgt_single s USING (product_code) WHERE layer = 1 AND NOT (g1 IS NULL AND g2 IS NULL)),
     f AS (SELECT *, "match_L1" AND "match_L2" AS "partial_match_L1L2", "match_L1" AND "match_L2" AND "match_L3" AS exact_match,
                  "match_L1" AND "match_L2" AND "match_L3" AND "match_L4" AND "match_L5" AS full_match FROM one),
     two AS (SELECT product_code, coalesce(bool_or({' AND '.join(P[:3])}) FILTER (g2 IS NOT NULL), false) AS can,
                    coalesce(bool_or({' AND '.join(P)}) FILTER (g2 IS NOT NULL), false) AS ful
             FROM ppred LEFT JOIN pgt USING (product_code) WHERE layer = 2 GROUP BY 1),
     kept AS (SELECT * FROM ppred LEFT JOIN pgt_counts USING (product_code) WHERE NOT (layer = 1 AND coalesce(n, 0) > 1)),
     a AS (SELECT count(*) AS codes, CAST(sum(account_count) AS BIGINT) AS total_weight, count(*) FILTER (layer = 2) AS l2_codes, count(*) FILTER (layer = 3) AS l3_codes FROM kept),
     b AS (SELECT count(*) AS l1_codes, CAST(coalesce(sum(account_count), 0) AS BIGINT) AS l1_weight,
                  {', '.join(f'round(avg(CAST("{f}" AS DOUBLE)), 6) AS "{f}"' for f in PRODUCT_KPI_FLAGS)},
                  {', '.join(f'round(coalesce(sum(account_count) FILTER ("{f}"), 0)::DOUBLE / greatest(sum(account_count), 1), 6) AS "w_{f}"' for f in PRODUCT_KPI_FLAGS[5:])} FROM f),
     c AS (SELECT coalesce(round(avg(CAST(can AS DOUBLE)), 6), 0.0::DOUBLE) AS l2_any_match, coalesce(round(avg(CAST(ful AS DOUBLE)), 6), 0.0::DOUBLE) AS l2_any_full_match FROM two)
SELECT *, CASE WHEN "w_exact_match" >= 0.8 THEN 'MET' ELSE 'BELOW TARGET' END AS target FROM a, b, c"""))
def q_kpi_products(spark: SparkSession, sf: str) -> DataFrame:
    return evaluation.kpi(evaluated_products(spark, sf), PRODUCT, "account_count")


@query("q_cost_summary", with_views("pred", """
WITH b AS (SELECT prompt_version, batch_id, max(tokens_in) AS ti, max(tokens_out) AS tou, max(estimated_cost) AS c, sum(estimated_cost) AS r, count(*) AS n
           FROM pred GROUP BY 1, 2)
SELECT prompt_version, CAST(sum(n) AS BIGINT) AS codes, count(*) AS batches, CAST(sum(ti) AS BIGINT) AS tokens_in, CAST(sum(tou) AS BIGINT) AS tokens_out,
       round(sum(c), 6) AS estimated_cost, round(sum(r), 6) AS cost_by_rows, round(sum(c) / greatest(sum(n), 1), 6) AS cost_per_code
FROM b GROUP BY 1"""))
def q_cost_summary(spark: SparkSession, sf: str) -> DataFrame:
    return evaluation.batch_costs(v.predictions(spark, sf), ["prompt_version"])


@query("q_confidence_stats", with_views("pred", """
SELECT CAST(count(confidence) AS BIGINT) AS count, round(avg(confidence), 6) AS mean, round(stddev_samp(confidence), 6) AS std, min(confidence) AS min,
       round(quantile_cont(confidence, 0.25), 6) AS p25, round(quantile_cont(confidence, 0.5), 6) AS p50,
       round(quantile_cont(confidence, 0.75), 6) AS p75, max(confidence) AS max
FROM pred"""))
def q_confidence_stats(spark: SparkSession, sf: str) -> DataFrame:
    stats = ordering.describe_numeric(v.predictions(spark, sf), "confidence")
    return stats.select("count", *[F.round(c, 6).alias(c) for c in ("mean", "std", "min", "p25", "p50", "p75", "max")])


@query("q_value_stats", """
SELECT count(*) AS count, round(avg(l_extendedprice), 4) AS mean, round(stddev_samp(l_extendedprice), 4) AS std, min(l_extendedprice) AS min,
       round(quantile_cont(l_extendedprice, 0.25), 4) AS p25, round(quantile_cont(l_extendedprice, 0.5), 4) AS p50,
       round(quantile_cont(l_extendedprice, 0.75), 4) AS p75, max(l_extendedprice) AS max FROM lineitem""")
def q_value_stats(spark: SparkSession, sf: str) -> DataFrame:
    stats = ordering.describe_numeric(v.table(spark, sf, "lineitem"), "l_extendedprice")
    return stats.select("count", *[F.round(c, 4).alias(c) for c in ("mean", "std", "min", "p25", "p50", "p75", "max")])


@query("q_low_confidence", with_views("pred", """
SELECT prompt_version, transaction_code, confidence FROM pred WHERE category_1 <> 'ERROR' AND confidence < 0.8"""))
def q_low_confidence(spark: SparkSession, sf: str) -> DataFrame:
    low = inference.low_confidence(v.predictions(spark, sf), "category_1")
    return low.select("prompt_version", "transaction_code", "confidence")


AUDIT_SQL = """
SELECT audit, "column", failing_rows, failing_rows = 0 AS passed FROM (
  SELECT 'not_null' AS audit, 'category_4' AS "column", count(*) FILTER (category_4 IS NULL) AS failing_rows FROM pred
  UNION ALL SELECT 'not_null', 'transaction_code', count(*) FILTER (transaction_code IS NULL) FROM pred
  UNION ALL SELECT 'accepted_values', 'category_2', count(*) FILTER (category_2 NOT IN ('PROMO', 'ECONOMY', 'LARGE', 'SMALL')) FROM pred
  UNION ALL SELECT 'accepted_range', 'confidence', count(*) FILTER (confidence < 0.1 OR confidence > 0.9) FROM pred
  UNION ALL SELECT 'error_rows', 'category_1', count(*) FILTER (category_1 = 'ERROR') FROM pred
  UNION ALL SELECT 'unique_combination', 'transaction_code', count(*) FROM (SELECT transaction_code FROM pred GROUP BY 1 HAVING count(*) > 1)
  UNION ALL SELECT 'unique_combination', 'prompt_version,transaction_code', count(*) FROM (SELECT 1 FROM pred GROUP BY prompt_version, transaction_code HAVING count(*) > 1)
  UNION ALL SELECT 'row_count', 'pred', CAST(CASE WHEN count(*) < 1 THEN 1 ELSE 0 END AS BIGINT) FROM pred)"""


@query("q_audits", with_views("pred", AUDIT_SQL))
def q_audits(spark: SparkSession, sf: str) -> DataFrame:
    pred = audits.require_columns(settle(v.predictions(spark, sf)), ["transaction_code", "layer", "category_1", "prompt_version"])
    checks = [
        *audits.not_null(["category_4", "transaction_code"]),
        audits.accepted_values("category_2", ["PROMO", "ECONOMY", "LARGE", "SMALL"]),
        audits.accepted_range("confidence", 0.1, 0.9),
        audits.marked("category_1"),
    ]
    return audits.all_audits([
        audits.row_audits(pred, checks),
        audits.unique_combination(pred, ["transaction_code"]),
        audits.unique_combination(pred, ["prompt_version", "transaction_code"]),
        audits.row_count(pred, "pred"),
    ])


def _legal_sql() -> str:
    rows = ["(" + ", ".join("NULL" if x is None else f"'{x}'" for x in p) + ")" for p in taxonomy.transaction_paths()]
    return f"legal(a, b, c, d) AS (VALUES {', '.join(rows)})"


@query("q_taxonomy_valid", with_views("pred", f"""WITH {_legal_sql()},
q AS (SELECT prompt_version, transaction_code, CASE WHEN upper(category_1) = 'FEE ITEM' THEN 'Fee item' ELSE 'Non-fee item' END AS c1,
             CASE WHEN category_2 IN ('PROMO', 'SMALL') THEN 'nsf/od' WHEN category_2 = 'LARGE' THEN 'Money movement' ELSE category_2 END AS c2,
             CASE WHEN category_2 = 'LARGE' AND category_3 = 'red' THEN 'Wire' WHEN category_2 = 'LARGE' THEN category_3 END AS c3,
             CASE WHEN category_2 = 'LARGE' AND category_3 = 'red' THEN 'Domestic' END AS c4 FROM pred)
SELECT prompt_version, transaction_code, c2 FROM q WHERE NOT EXISTS (
  SELECT 1 FROM legal WHERE ({canon_sql('c1')}) = ({canon_sql('a')}) AND ({canon_sql('c2')}) = ({canon_sql('b')})
   AND ({canon_sql('c3')}) = ({canon_sql('c')}) AND ({canon_sql('c4')}) = ({canon_sql('d')}))"""))
def q_taxonomy_valid(spark: SparkSession, sf: str) -> DataFrame:
    """Predictions dressed in taxonomy words; those off the tree are reported."""
    level2, level3 = F.col("category_2"), F.col("category_3")
    wire = (level2 == "LARGE") & (level3 == "red")
    dressed = v.predictions(spark, sf).select(
        "prompt_version", "transaction_code",
        F.when(F.upper("category_1") == "FEE ITEM", "Fee item").otherwise("Non-fee item").alias("c1"),
        F.when(level2.isin("PROMO", "SMALL"), "nsf/od").when(level2 == "LARGE", "Money movement").otherwise(level2).alias("c2"),
        F.when(wire, "Wire").when(level2 == "LARGE", level3).alias("c3"), F.when(wire, "Domestic").alias("c4"),
    )
    off = taxonomy.illegal_predictions(dressed, ["c1", "c2", "c3", "c4"], taxonomy.transaction_paths())
    return off.select("prompt_version", "transaction_code", "c2")


@query("q_label_eval", """
WITH j AS (SELECT lang, n_chars, (length(text) - length(replace(text, '.', '')) > 20) = (quality = 1) AS hit, toxic = 1 AS toxic
           FROM documents JOIN labels USING (doc_id))
SELECT lang, count(*) AS codes, CAST(sum(n_chars) AS BIGINT) AS weight, round(avg(CAST(hit AS DOUBLE)), 6) AS hit,
       round(coalesce(sum(n_chars) FILTER (hit), 0)::DOUBLE / greatest(sum(n_chars), 1), 6) AS w_hit, round(avg(CAST(toxic AS DOUBLE)), 6) AS toxic,
       round(coalesce(sum(n_chars) FILTER (toxic), 0)::DOUBLE / greatest(sum(n_chars), 1), 6) AS w_toxic
FROM j GROUP BY 1""")
def q_label_eval(spark: SparkSession, sf: str) -> DataFrame:
    """A rule flag over whole texts against the label, plain and weighted by length, per language."""
    stops = F.length("text") - F.length(F.replace("text", F.lit("."), F.lit("")))
    docs = v.table(spark, sf, "documents").select("doc_id", "lang", "n_chars", (stops > 20).alias("flag"))
    labels = v.table(spark, sf, "labels")
    frame = docs.join(labels, "doc_id").select(
        "lang", "n_chars", (F.col("flag") == (F.col("quality") == 1)).alias("hit"), (F.col("toxic") == 1).alias("toxic")
    )
    return evaluation.accuracy(frame, ["hit", "toxic"], "n_chars", ["lang"])


@query("q_match_rules", with_views("pred gt_single", f"""
SELECT prompt_version, transaction_code, {', '.join(f'{lenient_sql(f"category_{i}", chr(34) + f"gt_L{i}" + chr(34))} AS "match_L{i}"' for i in range(1, 5))},
       {', '.join(f'{strict_sql(f"category_{i}", chr(34) + f"gt_L{i}" + chr(34))} AS "strict_L{i}"' for i in range(1, 5))}
FROM pred JOIN gt_single USING (transaction_code)"""))
def q_match_rules(spark: SparkSession, sf: str) -> DataFrame:
    """Lenient and strict comparison of every level side by side."""
    profile = matching.truth_profile(v.truth(spark, sf), "transaction_code", TRANSACTION, ["gt_desc"], ORDER)
    joined = v.predictions(spark, sf).join(profile.filter(F.col("n_mappings") == 1), "transaction_code")
    strict = {f"strict_L{i + 1}": match_strict(p, t) for i, (p, t) in enumerate(zip(TRANSACTION.pred, TRANSACTION.truth))}
    return joined.withColumns({**level_matches(TRANSACTION), **strict}).select(
        "prompt_version", "transaction_code", *level_matches(TRANSACTION), *strict
    )
