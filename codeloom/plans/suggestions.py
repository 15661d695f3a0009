"""Suggestions for unknown product codes, their review routing, and the master table they end up in."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from codeloom import schemas
from codeloom.functions.text import code_key, strip, surrogate_id
from codeloom.operators import batching, inference, rules
from codeloom.operators.inference import Backend
from codeloom.operators.normalize import conform

# Supported lines of business and review states.
SUPPORTED_LOB = ("RETAIL", "BUSINESS")
PENDING, MANUAL_MAPPING, MANUAL_REVIEW = "PENDING_REVIEW", "REQUIRES_MANUAL_MAPPING", "NEEDS_MANUAL_REVIEW"
UNCLASSIFIED_STATE = "Unclassified"


def review_status(lob: Column) -> Column:
    return F.when(lob.isin(*SUPPORTED_LOB), F.lit(PENDING)).otherwise(F.lit(MANUAL_MAPPING))


def suggest(
    catalog: DataFrame, prompt_version: str, run_timestamp: Column, backend: Backend | None = None,
    model: str = "rules", system: str = "", size: int = batching.SUGGESTION_BATCH,
    wait: Callable[[int], float] = inference.wait_seconds, sample_limit: int | None = None,
) -> DataFrame:
    """Suggestion table for an uncategorized catalog (product_code, volume, prod_status, description_samples).

    ``sample_limit`` cuts the samples in the prompt (MAX_DESCRIPTION is the usual length); rules always see all of them.
    """
    meta = {
        "description_samples": F.lit(""), "volume": F.lit(0).cast("bigint"), "prod_status": F.lit("ACTIVE"),
    }
    items: dict[str, Column | str] = {
        "code": "product_code", "description_samples": "description_samples", "volume": "volume",
        "prod_status": "prod_status",
    }
    if backend is None:
        catalog = catalog.withColumn("_placed", rules.suggestion_placement("description_samples")).withColumn(
            "_answer", F.struct(F.col("product_code").alias("PROD_core_system_mapping"), F.col("_placed.*"))
        ).drop("_placed")
        items["_answer"] = "_answer"
    batched = batching.assign_batches(catalog, None, ["product_code"], size)
    requests = batching.batch_requests(batched, batching.suggestion_line(sample_limit), items, system=system)
    answered = (
        inference.answer_with(requests, lambda i: i["_answer"]) if backend is None
        else inference.ask(requests, backend, wait=wait)
    )
    priced = answered.withColumn("model_name", F.lit(model))
    answers = inference.read_answers(priced, schemas.SUGGESTION_RESPONSE, "PROD_core_system_mapping", meta)
    return suggestion_rows(answers, prompt_version, run_timestamp)


def suggestion_rows(answers: DataFrame, prompt_version: str, run_timestamp: Column) -> DataFrame:
    """Post-processing: capitals, surrogate id, flags, routing; failed and omitted codes stay visible."""
    bad = F.col("outcome") != "ok"

    def level(name: str) -> Column:
        return F.when(~bad, F.upper(strip(F.col(f"answer.{name}"))))

    required = {n: F.coalesce(level(n), F.when(~bad, F.lit(""))) for n in
                ("PROD_line_of_business", "PROD_product_category", "PROD_product_type")}
    code = code_key("code")
    stamp = run_timestamp
    shaped = answers.select(
        surrogate_id("code").alias("PROD_product_type_id"),
        *[expr.alias(name) for name, expr in required.items()],
        level("PROD_product_name").alias("PROD_product_name"),
        level("PROD_product_code").alias("PROD_product_code"),
        F.col("prod_status").alias("PROD_status"),
        code.alias("PROD_core_system_mapping"),
        F.coalesce(required["PROD_product_category"] == "LOANS", F.lit(False)).alias("PROD_balance_requires_abs"),
        stamp.alias("PROD_created_date"),
        stamp.alias("PROD_modified_date"),
        stamp.alias("processing_timestamp"),
        F.when(bad, F.lit(MANUAL_REVIEW)).otherwise(review_status(required["PROD_line_of_business"])).alias("review_status"),
        F.coalesce(F.when(~bad, F.col("answer.confidence")), F.lit(0.0)).alias("confidence"),
        F.col("model_name").alias("ai_model"),
        F.lit(prompt_version).alias("prompt_version"),
        F.when(bad, F.concat(F.lit("ERROR: "), F.col("message"))).otherwise(F.col("description_samples")).alias("description_samples"),
        "volume",
    )
    return conform(shaped, schemas.PRODUCT_SUGGESTIONS)


def merge_approved(master: DataFrame, suggestions: DataFrame) -> DataFrame:
    """Approved suggestions flow into the master: matching codes are updated, new ones added.

    The result is written as a new table, so it is one full outer join on the normalized code. Of several approved rows of a
    code, the one changed last counts.
    """
    fields = [f.name for f in schemas.PRODUCT_MASTER.fields]
    key = code_key("PROD_core_system_mapping")
    last = F.struct("PROD_modified_date", "confidence", *[f for f in fields if f != "PROD_modified_date"])
    new = (
        suggestions.filter(F.col("review_status") == "APPROVED").groupBy(key.alias("_key"))
        .agg(F.max_by(F.struct(*fields), last).alias("_new")).select("_key", *[F.col(f"_new.{f}").alias(f"n_{f}") for f in fields])
    )
    old = master.withColumn("_key", code_key("PROD_core_system_mapping"))
    joined = old.join(new, "_key", "full_outer")
    keep_old = ("PROD_product_type_id", "PROD_core_system_mapping", "PROD_created_date")
    return joined.select(
        *[
            (F.coalesce(f, f"n_{f}") if f in keep_old else F.coalesce(f"n_{f}", f)).alias(f)
            for f in fields
        ]
    )


def exception_report(catalog: DataFrame, taxonomy_codes: DataFrame, code: str, weight: str) -> DataFrame:
    """Codes that appeared after onboarding: not mapped yet, so Unclassified and reported, heaviest first."""
    known = taxonomy_codes.select(code_key(code).alias("_key")).distinct()
    fresh = catalog.withColumn("_key", code_key(code)).join(known, "_key", "left_anti").drop("_key")
    return fresh.withColumn("category_2", F.lit(UNCLASSIFIED_STATE)).orderBy(F.desc(weight), code)
