"""The evaluation table and every metric taken from it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from codeloom.functions.levels import (
    EVALUATED,
    MANUAL_REVIEW,
    TARGET,
    TRUTH_EXCLUDED,
    Levels,
    first_miss,
    informational_miss,
    match_names,
    with_matches,
)
from codeloom.operators.matching import truth_profile, with_agreement

ACCURACY_DIGITS = 6


def layer_one(
    pred: DataFrame, truth: DataFrame, spec: Levels, code: str, extra: Sequence[str], order: Sequence[str],
    drop_excluded: bool = False,
) -> DataFrame:
    """Single-mapping predictions next to their truth, with match columns.

    ``drop_excluded`` removes codes whose truth was filtered away (no first and no second level).
    """
    profile = truth_profile(truth, code, spec, extra, order).drop("n_mappings")
    joined = pred.filter(F.col("layer") == 1).join(profile, code, "left")
    if drop_excluded:
        joined = joined.filter(~(F.col(spec.truth[0]).isNull() & F.col(spec.truth[1]).isNull()))
    return with_matches(joined, spec)


def evaluate(
    pred: DataFrame, truth: DataFrame, spec: Levels, code: str, extra: Sequence[str], order: Sequence[str],
    exclude_missing: bool = False,
) -> DataFrame:
    """One row per prediction over all layers, in one frame.

    Layer 1 compares with the single path, layer 2 asks whether any path agrees, layer 3 waits for
    review; with ``exclude_missing``, layer-1 rows whose truth is gone are marked as excluded.
    Match columns of layers 2 and 3 stay null.
    """
    profile = truth_profile(truth, code, spec, extra, order)
    joined = with_agreement(pred, truth, spec, code, only=F.col("layer") == 2).join(profile, code, "left")
    gone = F.lit(False)
    if exclude_missing:
        gone = (F.col("layer") == 1) & F.col("n_mappings").isNull()
    scored = (F.col("layer") == 1) & ~gone
    # A layer-1 code whose remaining truth is not a single path has no truth to show and is dropped there.
    joined = joined.withColumns({"_gone": gone, "_scored": scored})
    if exclude_missing:
        no_truth = F.col(spec.truth[0]).isNull() & F.col(spec.truth[1]).isNull()
        joined = joined.filter(~(F.col("_scored") & no_truth))
    matched = with_matches(joined, spec)
    names = match_names(spec)
    ambiguous = F.col("layer") == 2
    out = matched.withColumn("_miss", first_miss(spec))
    if spec.decisive < spec.depth:
        out = out.withColumn("_miss", F.coalesce("_miss", informational_miss(spec)))
    settled: dict[str, Column] = {}
    for name in names:
        value = F.when(F.col("_scored"), F.col(name))
        if name in ("exact_match", "canonical_match"):
            value = F.when(F.col("_scored"), F.col(name)).when(ambiguous, F.col("exact_match_any"))
        elif name == "full_match":
            value = F.when(F.col("_scored"), F.col(name)).when(ambiguous, F.col("full_match_any"))
        settled[name] = value
    settled |= {t: F.when(F.col("_scored"), F.col(t)) for t in spec.truth}
    settled["failure_type"] = (
        F.when(F.col("_gone"), F.lit(TRUTH_EXCLUDED))
        .when(F.col("_scored"), F.col("_miss"))
        .when(ambiguous & ~F.col("exact_match_any"), F.lit(spec.ambiguous_miss))
    )
    settled["review_status"] = (
        F.when(F.col("_gone"), F.lit(TRUTH_EXCLUDED))
        .when(F.col("layer") == 3, F.lit(MANUAL_REVIEW))
        .otherwise(F.lit(EVALUATED))
    )
    kept = [c for c in pred.columns]
    return out.select(*kept, *[expr.alias(name) for name, expr in settled.items()])


def rate(flag: Column) -> Column:
    """Share of true among non-null values."""
    return F.round(F.avg(flag.cast("double")), ACCURACY_DIGITS)


def weighted_rate(flag: Column, weight: Column) -> Column:
    """Weight of the true rows over the total weight, guarded against an empty total."""
    hit = F.coalesce(F.sum(F.when(flag, weight)), F.lit(0))
    return F.round(hit / F.greatest(F.coalesce(F.sum(weight), F.lit(0)), F.lit(1)), ACCURACY_DIGITS)


def accuracy(frame: DataFrame, flags: Sequence[str], weight: str, by: Sequence[str] = ()) -> DataFrame:
    """Plain and weighted accuracy of every flag in one pass."""
    metrics = [F.count("*").alias("codes"), F.coalesce(F.sum(weight), F.lit(0)).alias("weight")]
    for flag in flags:
        metrics.append(rate(F.col(flag)).alias(flag))
        metrics.append(weighted_rate(F.col(flag), F.col(weight)).alias(f"w_{flag}"))
    return frame.groupBy(*by).agg(*metrics) if by else frame.agg(*metrics)


def failure_distribution(evaluated: DataFrame, code: str, weight: str, examples: int = 4) -> DataFrame:
    """Failures per type: count, weight and the first example codes; only those are ever collected."""
    failed = (
        evaluated.filter(F.col("failure_type").isNotNull())
        .groupBy("failure_type", code)
        .agg(F.count("*").alias("_n"), F.sum(weight).alias("_w"))
    )
    totals = failed.groupBy("failure_type").agg(
        F.sum("_n").alias("count"), F.coalesce(F.sum("_w"), F.lit(0)).alias("weight")
    )
    window = Window.partitionBy("failure_type").orderBy(code)
    shown = (
        failed.withColumn("rn", F.row_number().over(window))
        .filter(F.col("rn") <= examples)
        .groupBy("failure_type")
        .agg(F.array_join(F.array_sort(F.collect_list(code)), ", ").alias("examples"))
    )
    return totals.join(shown, "failure_type").orderBy(F.desc("count"), "failure_type")


def mismatches(matched: DataFrame, spec: Levels, code: str, carry: Sequence[str] = ()) -> DataFrame:
    """One row per prediction and wrong level."""
    entries = F.array(
        *[
            F.struct(
                F.lit(f"L{i + 1}").alias("level"),
                F.col(p).alias("predicted"),
                F.col(t).alias("expected"),
                F.col(f"match_L{i + 1}").alias("ok"),
            )
            for i, (p, t) in enumerate(zip(spec.pred, spec.truth))
        ]
    )
    return (
        matched.select(code, *carry, F.inline(entries))
        .filter(~F.col("ok"))
        .drop("ok")
    )


def batch_costs(results: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Tokens and cost taken once per batch, next to the plain row sum and the cost per code.

    Every row repeats the figures of its batch, so a row sum counts a batch as often as it has rows.
    """
    per_batch = results.groupBy(*by, "batch_id").agg(
        F.max("tokens_in").alias("tokens_in"),
        F.max("tokens_out").alias("tokens_out"),
        F.max("estimated_cost").alias("cost"),
        F.sum("estimated_cost").alias("row_sum"),
        F.count("*").alias("codes"),
    )
    sums = [
        F.sum("codes").alias("codes"),
        F.count("*").alias("batches"),
        F.sum("tokens_in").alias("tokens_in"),
        F.sum("tokens_out").alias("tokens_out"),
        F.round(F.sum("cost"), 6).alias("estimated_cost"),
        F.round(F.sum("row_sum"), 6).alias("cost_by_rows"),
        F.round(F.sum("cost") / F.greatest(F.sum("codes"), F.lit(1)), 6).alias("cost_per_code"),
    ]
    return per_batch.groupBy(*by).agg(*sums) if by else per_batch.agg(*sums)


def target_status(metric: Column, target: float = TARGET) -> Column:
    return F.when(metric >= target, F.lit("MET")).otherwise(F.lit("BELOW TARGET"))


def kpi(evaluated: DataFrame, spec: Levels, weight: str, target: float = TARGET) -> DataFrame:
    """The summary report as one row, from one scan of the evaluation table."""
    w = F.col(weight)
    # Excluded rows keep layer 1 but have no verdict.
    first = (F.col("layer") == 1) & F.col("exact_match").isNotNull()
    second = F.col("layer") == 2
    cells = [
        F.count("*").alias("codes"),
        F.coalesce(F.sum(w), F.lit(0)).alias("total_weight"),
        F.count_if(first).alias("l1_codes"),
        F.coalesce(F.sum(F.when(first, w)), F.lit(0)).alias("l1_weight"),
        F.count_if(second).alias("l2_codes"),
        F.count_if(F.col("layer") == 3).alias("l3_codes"),
        F.coalesce(rate(F.when(second, F.col("exact_match"))), F.lit(0.0)).alias("l2_any_match"),
    ]
    flags = [f"match_L{i + 1}" for i in range(spec.depth)] + ["partial_match_L1L2", "exact_match"]
    weighted = ["partial_match_L1L2", "exact_match"]
    if spec.decisive < spec.depth:
        # Levels behind the decisive ones are reported for information.
        flags.append("full_match")
        weighted.append("full_match")
        cells.append(F.coalesce(rate(F.when(second, F.col("full_match"))), F.lit(0.0)).alias("l2_any_full_match"))
    for flag in flags:
        cells.append(rate(F.when(first, F.col(flag))).alias(flag))
    for flag in weighted:
        cells.append(weighted_rate(F.when(first, F.col(flag)), F.when(first, w)).alias(f"w_{flag}"))
    return evaluated.agg(*cells).withColumn("target", target_status(F.col("w_exact_match"), target))
