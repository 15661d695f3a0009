"""Codes of the account history that the master table does not know yet."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from codeloom.functions.text import code_key, strip
from codeloom.operators.frequency import ranked, sample_text, status_any_active

SAMPLES = 3


def uncategorized_catalog(
    history: DataFrame, master: DataFrame, samples: int = SAMPLES, current_only: bool = False,
    status_rule: Callable[[Column], Column] = status_any_active,
    code: str = "ProductInstanceReference", text: str = "ProductInstanceDescription", status: str = "AccountStatus",
    mapping: str = "PROD_core_system_mapping",
) -> DataFrame:
    """One row per unknown code: volume, product status and most frequent descriptions.

    Rows are counted by their raw cells first: the map-side combine absorbs a code that holds a third
    of all rows, and cells are cleaned once per distinct value instead of once per row. The master is
    removed at one row per code; an anti join needs no null check because null keys never match. Codes
    are compared and grouped by their normalized key. With ``current_only``, versions that have ended
    are left out.
    """
    source = history.filter(F.col("valid_to").isNull()) if current_only else history
    raw = source.filter(F.col(code).isNotNull()).groupBy(code, text, status).agg(F.count("*").alias("n"))
    # A key that cannot be null keeps joins from adding null filters to one of the branches only.
    cleaned = raw.select(
        F.coalesce(code_key(code), F.lit("")).alias("product_code"), strip(F.col(text).cast("string")).alias("text"),
        F.upper(strip(F.col(status).cast("string"))).alias("state"), "n",
    )
    counts = cleaned.groupBy("product_code", "text", "state").agg(F.sum("n").alias("n"))
    # Written over the count, so that it is not pushed down and cleaned row by row after all.
    counts = counts.filter(F.when(F.col("product_code") != "", F.col("n")) > 0)
    codes = counts.groupBy("product_code").agg(
        F.sum("n").alias("volume"), status_rule(F.col("state")).alias("prod_status")
    )
    known = master.select(code_key(mapping).alias("product_code"))
    texts = counts.groupBy("product_code", "text").agg(F.sum("n").alias("n"))
    listed = ranked(texts, "product_code", "text", samples, F.col("text").isin("", "nan", "None")).groupBy("product_code").agg(
        F.collect_list(F.struct("rn", "text", "n")).alias("_samples")
    )
    found = F.coalesce(F.col("_samples"), F.array().cast("array<struct<rn:int,text:string,n:bigint>>"))
    return codes.join(known, "product_code", "left_anti").join(listed, "product_code", "left").select(
        "product_code", "volume", "prod_status", sample_text(found, "text").alias("description_samples")
    )
