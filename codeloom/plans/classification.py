"""Catalog to classification table: batch, ask, read, price."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from codeloom import schemas
from codeloom.functions.pricing import PRODUCT_PRICES, TRANSACTION_PRICES
from codeloom.operators import batching, inference, rules
from codeloom.operators.inference import Backend

RULES_MODEL = "rules"


def _with_transaction_answer(catalog: DataFrame) -> DataFrame:
    placed = catalog.withColumn("_placed", rules.transaction_placement("description_samples"))
    answer = F.struct(
        F.col("transaction_code"),
        *[F.col(f"_placed.category_{i}").alias(f"category_{i}") for i in range(1, 5)],
        rules.include_in_scoring("_placed.category_1", "_placed.category_2").alias("include_in_scoring"),
        rules.direction("description_samples").alias("credit_debit"),
        F.col("_placed.confidence").alias("confidence"),
    )
    return placed.withColumn("_answer", answer).drop("_placed")


def classify_transactions(
    catalog: DataFrame, prompt_version: str, run_timestamp: Column, backend: Backend | None = None,
    model: str = RULES_MODEL, system: str = "", size: int = batching.TRANSACTION_BATCH,
    prices: Mapping[str, tuple[float, float]] = TRANSACTION_PRICES, wait: Callable[[int], float] = inference.wait_seconds,
) -> DataFrame:
    """Classify a catalog (transaction_code, description_samples, volume, source_file, layer).

    A code may come from several source files and is a row in each, so batches hold codes of one layer and source file. Without a backend the rule table answers inside the JVM: the
    placement of every code is computed once per catalog row, before batching.
    """
    meta = {
        "description_samples": F.lit(""), "volume": F.lit(0).cast("bigint"), "source_file": F.lit(""),
        "layer": F.lit(3),
    }
    items: dict[str, Column | str] = {
        "code": "transaction_code", "description_samples": "description_samples", "volume": "volume",
        "source_file": "source_file", "layer": "layer",
    }
    if backend is None:
        catalog = _with_transaction_answer(catalog)
        items["_answer"] = "_answer"
    batched = batching.assign_batches(catalog, ["layer", "source_file"], ["transaction_code"], size)
    requests = batching.batch_requests(batched, batching.transaction_line(), items, system=system)
    answered = (
        inference.answer_with(requests, lambda i: i["_answer"]) if backend is None
        else inference.ask(requests, backend, wait=wait)
    )
    priced = inference.with_costs(answered, model, prices)
    answers = inference.read_answers(priced, schemas.TRANSACTION_RESPONSE, "transaction_code", meta)
    return inference.transaction_results(answers, prompt_version, run_timestamp)


def classify_products(
    catalog: DataFrame, prompt_version: str, run_timestamp: Column, backend: Backend | None = None,
    model: str = RULES_MODEL, system: str = "", sizes: Mapping[str, int] = batching.PRODUCT_BATCH,
    prices: Mapping[str, tuple[float, float]] = PRODUCT_PRICES, wait: Callable[[int], float] = inference.wait_seconds,
) -> DataFrame:
    """Classify a product catalog; batches hold codes of one source file."""
    meta = {
        "product_name": F.lit(""), "source_file": F.lit(""), "account_count": F.lit(0).cast("bigint"),
        "layer": F.lit(3),
    }
    items: dict[str, Column | str] = {
        "code": "product_code", "product_name": "product_name", "source_file": "source_file",
        "account_count": "account_count", "layer": "layer",
    }
    if backend is None:
        dominant = F.element_at(F.map_keys(F.from_json("purcod_distribution", "map<string,double>")), 1)
        placed = rules.product_placement("product_name", "source_file", dominant)
        catalog = catalog.withColumn("_placed", placed).withColumn(
            "_answer", F.struct(F.col("product_code"), F.col("_placed.*"))
        ).drop("_placed")
        items["_answer"] = "_answer"
    batched = batching.assign_batches(catalog, "source_file", ["product_code"], sizes)
    requests = batching.batch_requests(batched, batching.product_line(), items, system=system)
    answered = (
        inference.answer_with(requests, lambda i: i["_answer"]) if backend is None
        else inference.ask(requests, backend, wait=wait)
    )
    priced = inference.with_costs(answered, model, prices)
    answers = inference.read_answers(priced, schemas.PRODUCT_RESPONSE, "product_code", meta)
    return inference.product_results(answers, prompt_version, run_timestamp)
