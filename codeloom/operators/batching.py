"""Fixed-size batches of codes and their prompts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from codeloom.functions.text import code_line, describe_or_placeholder, sanitize_description
from codeloom.operators.ordering import running_total

# Codes per request of each pipeline.
TRANSACTION_BATCH = 15
PRODUCT_BATCH = {"Deposit": 30, "Loan": 10}
SUGGESTION_BATCH = 30

HEADER = "Classify the {n} codes listed below."
FOOTER = 'Answer with a JSON object whose "classifications" array holds one entry per code.'


def batch_size(group: str, sizes: int | Mapping[str, int], default: int = SUGGESTION_BATCH) -> Column:
    if isinstance(sizes, int):
        return F.lit(sizes)
    size = F.lit(default)
    for name, number in sizes.items():
        size = F.when(F.col(group) == name, F.lit(number)).otherwise(size)
    return size


def assign_batches(
    catalog: DataFrame, group: str | Sequence[str] | None, order: Sequence[str], sizes: int | Mapping[str, int]
) -> DataFrame:
    """Number the codes of each group in ``order`` and cut them into batches. Sizes by name go by the first group column.

    The batch depends on the data alone, so a retried task rebuilds the same batches, and the
    numbering never sorts a whole group (there are only a few, each large) in one task.
    """
    by = [group] if isinstance(group, str) else list(group or ())
    numbered = running_total(catalog, by, order, out="_at")
    size = batch_size(by[0] if by else "", sizes)
    label = F.floor((F.col("_at") - 1) / size).cast("bigint")
    name = F.concat_ws("-", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in by], label.cast("string"))
    position = (F.col("_at") - 1 - label * size).cast("int")
    return numbered.select(*catalog.columns, label.alias("batch_no"), name.alias("batch_id"), position.alias("position"))


def transaction_line() -> Column:
    return code_line([
        ("transaction_code", F.col("transaction_code"), False),
        ("SAMPLES", describe_or_placeholder("description_samples"), True),
        ("VOLUME", F.col("volume"), False),
    ])


def product_line() -> Column:
    """Loan lines also carry the two distributions when there are any."""
    def known(name: str) -> Column:
        text = F.trim(F.col(name))
        return F.when(~text.isin("", "nan", "None"), F.col(name))

    return code_line([
        ("product_code", F.col("product_code"), False),
        ("DESC", describe_or_placeholder("product_name", ("nan", "", "None", "(unknown)")), True),
        ("DOMAIN", F.trim("source_file"), False),
        ("PURCOD_DIST", known("purcod_distribution"), False),
        ("PURPOSE_DIST", known("purpose_distribution"), False),
    ])


def suggestion_line(limit: int | None = None) -> Column:
    """``limit`` cuts the joined samples, as a model with a small window may need; by default a prompt shows all evidence."""
    return code_line([
        ("product_code", F.col("product_code"), False),
        ("SAMPLES", describe_or_placeholder(sanitize_description(F.trim("description_samples"), limit)), True),
        ("VOLUME", F.col("volume"), False),
    ])


def batch_requests(
    batched: DataFrame, line: Column, items: Mapping[str, Column | str], system: str = "",
    header: str = HEADER, footer: str = FOOTER,
) -> DataFrame:
    """One row per batch: its items as an array in batch order, and the rendered prompt.

    A batch holds at most its batch size, so the collected arrays are bounded.
    """
    fields = [F.col(c).alias(n) if isinstance(c, str) else c.alias(n) for n, c in items.items()]
    entry = F.struct(F.col("position"), line.alias("line"), *fields)
    grouped = batched.groupBy("batch_id").agg(F.array_sort(F.collect_list(entry)).alias("items"))
    lines = F.array_join(F.transform("items", lambda i: F.concat(F.lit("  - "), i["line"])), "\n")
    before, _, after = header.partition("{n}")
    heading = F.concat(F.lit(before), F.size("items").cast("string"), F.lit(after)) if after else F.lit(header)
    user = F.concat_ws("\n\n", heading, lines, F.lit(footer))
    prompt = F.concat_ws("\n", F.lit(system), user) if system else user
    return grouped.withColumn("prompt", prompt)
