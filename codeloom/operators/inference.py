"""Batched structured inference behind a small interface.

A backend answers one prompt with JSON text. ``ask`` runs any Python backend partition by partition
with retries; ``answer_with`` builds the answer with column expressions and needs no Python at all.
Both give the same frame, and everything after it works on one batch row at a time: no join, no
shuffle, and a retried task sees its own answer only.
"""

from __future__ import annotations

import json
import sys
import time
from collections.abc import Callable, Iterator, Mapping, Sequence

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from codeloom.functions.pricing import estimate_cost
from codeloom.functions.text import code_key, estimate_tokens
from codeloom.operators import rules
from codeloom.operators.rules import direction_of, place_transaction
from codeloom.session import settle

# Workers need not have this package: what they call travels with the task.
for _module in (sys.modules[__name__], rules):
    cloudpickle.register_pickle_by_value(_module)

Backend = Callable[[str, list[dict]], str]

# Attempts per batch, length of a stored message where one is asked for, marker of a failed row.
ATTEMPTS = 3
MESSAGE_LENGTH = 200
# Tasks that ask a backend at the same time. A given number is kept by adaptive execution, so the waits of a slow backend overlap.
SPREAD = 64
ERROR = "ERROR"
OMITTED = "LLM omitted this code from response"


def wait_seconds(attempt: int) -> float:
    """2 s after the first failure, 4 s after the second."""
    return 2.0 ** attempt


def ask(
    requests: DataFrame, backend: Backend, attempts: int = ATTEMPTS, wait: Callable[[int], float] = wait_seconds,
    keep: bool = True, spread: int = SPREAD,
) -> DataFrame:
    """Send every batch to the backend, each with its own retries.

    Batches are dealt to ``spread`` tasks first, and every answer is handed on by itself. With ``keep`` the answers are written to the shared folder once,
    so a later branch or a lost executor does not ask (and pay) again.
    """
    schema = T.StructType(
        [*requests.schema.fields, T.StructField("raw_response", T.StringType()),
         T.StructField("attempts", T.IntegerType()), T.StructField("error", T.StringType())]
    )

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for at in range(len(frame)):
                out = frame.iloc[at:at + 1].copy()
                items = [i.asDict() if hasattr(i, "asDict") else dict(i) for i in out["items"].iloc[0]]
                text, tries, error = _one_batch(backend, out["prompt"].iloc[0], items, attempts, wait)
                yield out.assign(raw_response=[text], attempts=[tries], error=[error])

    answered = requests.repartition(spread, F.col("batch_id")).mapInPandas(run, schema)
    return settle(answered) if keep else answered


def _one_batch(
    backend: Backend, prompt: str, items: list[dict], attempts: int, wait: Callable[[int], float]
) -> tuple[str | None, int, str | None]:
    for attempt in range(1, attempts + 1):
        try:
            return backend(prompt, items), attempt, None
        except Exception as failure:  # a backend may fail in any way; the message becomes an error row
            message = str(failure)
            if attempt < attempts:
                time.sleep(wait(attempt))
    return None, attempts, message


def answer_with(requests: DataFrame, entry: Callable[[Column], Column]) -> DataFrame:
    """Answers built from the items by a column expression."""
    body = F.to_json(F.struct(F.transform("items", entry).alias("classifications")), {"ignoreNullFields": "false"})
    return requests.withColumns(
        {"raw_response": body, "attempts": F.lit(1), "error": F.lit(None).cast("string")}
    )


def rule_backend(prompt: str, items: list[dict]) -> str:
    """The transaction rules as a Python backend."""
    answers = []
    for item in items:
        path, confidence = place_transaction(item["description_samples"])
        answers.append({
            "transaction_code": item["code"],
            **{f"category_{i + 1}": v for i, v in enumerate(path)},
            "include_in_scoring": path[0] == "Non-fee item" and path[1] in ("NSF/OD", "Money movement"),
            "credit_debit": direction_of(item["description_samples"]),
            "confidence": confidence,
        })
    return json.dumps({"classifications": answers})


def with_costs(
    answered: DataFrame, model: str, prices: Mapping[str, tuple[float, float]]
) -> DataFrame:
    """Tokens and cost of every batch; a failed batch costs nothing."""
    failed = F.col("raw_response").isNull()
    tokens_in = F.when(failed, F.lit(0)).otherwise(estimate_tokens("prompt")).cast("bigint")
    tokens_out = F.when(failed, F.lit(0)).otherwise(estimate_tokens("raw_response")).cast("bigint")
    return answered.withColumns({
        "model_name": F.lit(model), "tokens_in": tokens_in, "tokens_out": tokens_out,
    }).withColumn("estimated_cost", estimate_cost(F.col("tokens_in"), F.col("tokens_out"), F.col("model_name"), dict(prices)))


def _occurrences(entries: Column, key: Callable[[Column], Column]) -> Column:
    """The key of every entry and which of its equals it is, from 0. A null key equals other null keys."""
    keys = F.transform(entries, key)
    return F.transform(
        keys, lambda k, i: F.struct(k.alias("key"), F.size(F.filter(F.slice(keys, F.lit(1), i), lambda e: e.eqNullSafe(k))).alias("nth"))
    )


def read_answers(
    answered: DataFrame, response_schema: str, code: str, meta: Mapping[str, Column], report_omitted: bool = True,
    message_length: int | None = None,
) -> DataFrame:
    """One row per item sent, and one per answer that no item asked for.

    The n-th answer with a code belongs to the n-th item of that code in the batch, by normalized code: every item gets one answer or
    is reported as omitted. An answer with an unknown or null code, or one more than there are items, is kept with default ``meta``
    values and ``was_requested`` false. An answer that cannot be read fails the whole batch: ``from_json`` gives a struct of nulls
    then, so the inner array is tested. ``outcome`` is ok, omitted or failed; ``message_length`` cuts long messages.
    """
    parsed = answered.withColumn("_answers", F.from_json("raw_response", response_schema)["classifications"])
    unreadable = F.col("_answers").isNull()
    message = F.coalesce(F.col("error"), F.lit("unreadable response"))

    def item_struct(item: Column) -> list[Column]:
        return [item[name].alias(name) for name in meta]

    answer_type = next(f for f in parsed.schema.fields if f.name == "_answers").dataType.elementType
    nothing = F.lit(None).cast(answer_type)
    parsed = parsed.withColumns({
        "_asked": F.arrays_zip(F.col("items").alias("item"), _occurrences(F.col("items"), lambda i: code_key(i["code"])).alias("id")),
        "_given": F.arrays_zip(
            F.coalesce("_answers", F.array().cast(f"array<{answer_type.simpleString()}>")).alias("answer"),
            _occurrences(F.coalesce("_answers", F.array().cast(f"array<{answer_type.simpleString()}>")), lambda a: code_key(a[code])).alias("id"),
        ),
    })

    def returned(given: Column) -> Column:
        same = F.filter("_asked", lambda a: (a["id"]["key"] == given["id"]["key"]) & (a["id"]["nth"] == given["id"]["nth"]))
        item = F.get(same, F.lit(0))["item"]
        return F.struct(
            given["answer"].alias("answer"),
            *item_struct(item),
            F.coalesce(given["answer"][code], F.lit("")).alias("code"),
            item.isNotNull().alias("was_requested"),
            F.lit("ok").alias("outcome"),
        )

    def missing(outcome: str) -> Callable[[Column], Column]:
        return lambda asked: F.struct(
            nothing.alias("answer"),
            *item_struct(asked["item"]),
            asked["item"]["code"].alias("code"),
            F.lit(True).alias("was_requested"),
            F.lit(outcome).alias("outcome"),
        )

    unanswered = F.filter("_asked", lambda a: ~F.coalesce(
        F.exists("_given", lambda g: (g["id"]["key"] == a["id"]["key"]) & (g["id"]["nth"] == a["id"]["nth"])), F.lit(False)
    ))
    good = F.transform("_given", returned)
    if report_omitted:
        good = F.concat(good, F.transform(unanswered, missing("omitted")))
    rows = F.when(unreadable, F.transform("_asked", missing("failed"))).otherwise(good)
    carried = [c for c in parsed.columns if c not in ("items", "_answers", "_asked", "_given", "error")]
    told = F.when(F.col("outcome") == "failed", F.col("_message")).when(F.col("outcome") == "omitted", F.lit(OMITTED))
    opened = parsed.withColumn("_message", message).select(*carried, "_message", F.inline(rows))
    defaulted = {name: F.coalesce(F.col(name), default) for name, default in meta.items()}
    shown = told if message_length is None else F.substring(told, 1, message_length)
    return opened.withColumns(defaulted).withColumn("message", shown).drop("_message")


def transaction_results(answers: DataFrame, prompt_version: str, run_timestamp: Column) -> DataFrame:
    """The classification table of transactions; failed and omitted codes carry the ERROR marker."""
    bad = F.col("outcome") != "ok"

    def field(name: str, otherwise: Column) -> Column:
        return F.when(bad, otherwise).otherwise(F.col(f"answer.{name}")).alias(name)

    none = F.lit(None).cast("string")
    return answers.select(
        F.col("code").alias("transaction_code"), "description_samples", "volume", "source_file", "layer",
        field("category_1", F.lit(ERROR)), field("category_2", F.col("message")),
        field("category_3", none), field("category_4", none),
        field("include_in_scoring", F.lit(False)), field("credit_debit", none), field("confidence", F.lit(0.0)),
        F.lit(prompt_version).alias("prompt_version"), "model_name", run_timestamp.alias("run_timestamp"),
        "tokens_in", "tokens_out", "estimated_cost",
        F.coalesce("raw_response", "message").alias("llm_raw"), "batch_id", "was_requested",
    )


def product_results(answers: DataFrame, prompt_version: str, run_timestamp: Column) -> DataFrame:
    """The classification table of products."""
    bad = F.col("outcome") != "ok"

    def field(name: str, otherwise: Column) -> Column:
        return F.when(bad, otherwise).otherwise(F.col(f"answer.{name}")).alias(name)

    none = F.lit(None).cast("string")
    return answers.select(
        F.col("code").alias("product_code"), "product_name", "source_file", "account_count", "layer",
        field("line_of_business", F.lit(ERROR)), field("product_type", F.col("message")),
        field("product_category", none), field("product_subcategory", none), field("product_special", none),
        field("confidence", F.lit(0.0)), field("reasoning", F.lit("")),
        F.lit(prompt_version).alias("prompt_version"), "model_name", run_timestamp.alias("run_timestamp"),
        "tokens_in", "tokens_out", "estimated_cost",
        F.coalesce("raw_response", "message").alias("llm_raw"), "batch_id", "was_requested",
    )


def valid_rows(results: DataFrame, marker: str) -> DataFrame:
    return results.filter(F.col(marker) != ERROR)


def error_rows(results: DataFrame, marker: str) -> DataFrame:
    return results.filter(F.col(marker) == ERROR)


def low_confidence(results: DataFrame, marker: str, below: float = 0.8) -> DataFrame:
    return valid_rows(results, marker).filter(F.col("confidence") < below)


def missing_codes(sent: DataFrame, returned: DataFrame, keys: Sequence[str], code: str) -> DataFrame:
    """Codes sent but not returned, for answers that arrive as a table of their own."""
    left = sent.withColumn("_key", code_key(code))
    right = returned.select(*keys, code_key(code).alias("_key")).distinct()
    return left.join(right, [*keys, "_key"], "left_anti").drop("_key")
