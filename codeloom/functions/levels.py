"""Level comparison rules and the two level layouts."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from codeloom.functions.text import NULL_MARK, canon


@dataclass(frozen=True)
class Levels:
    """Which prediction column answers which truth column, and how a miss is named."""

    pred: tuple[str, ...]
    truth: tuple[str, ...]
    decisive: int
    misses: tuple[str, ...]
    ambiguous_miss: str
    lenient_any: bool

    @property
    def depth(self) -> int:
        return len(self.pred)


# Column names and failure labels.
TRANSACTION = Levels(
    pred=("category_1", "category_2", "category_3", "category_4"),
    truth=("gt_L1", "gt_L2", "gt_L3", "gt_L4"),
    decisive=4,
    misses=("WRONG BLOCK (L1)", "WRONG CATEGORY (L2)", "WRONG CHANNEL (L3)", "WRONG SUBTYPE (L4)"),
    ambiguous_miss="AMBIGUOUS_NO_MATCH",
    lenient_any=False,
)
PRODUCT = Levels(
    pred=("line_of_business", "product_type", "product_category", "product_subcategory", "product_special"),
    truth=("gt_L1_line_of_business", "gt_L2_type", "gt_L3_category", "gt_L4_subcategory", "gt_L5_special"),
    decisive=3,
    misses=("WRONG LOB (L1)", "WRONG TYPE (L2)", "WRONG CATEGORY (L3)"),
    ambiguous_miss="AMBIGUOUS_NO_CANONICAL_MATCH",
    lenient_any=True,
)
# Layers, review states, supported lines of business, target.
LAYER_NAMES = {1: "Obvious", 2: "Ambiguous", 3: "Unknown"}
EVALUATED = "EVALUATED"
MANUAL_REVIEW = "NEEDS MANUAL REVIEW"
TRUTH_EXCLUDED = "GT_LOB_EXCLUDED"
VALID_LOB = ("retail", "business")
TARGET = 0.80


def match_strict(pred: Column | str, truth: Column | str) -> Column:
    return canon(pred) == canon(truth)


def match_lenient(pred: Column | str, truth: Column | str) -> Column:
    """An empty truth level asks for nothing, so it always matches."""
    wanted = canon(truth)
    return (wanted == NULL_MARK) | (canon(pred) == wanted)


def all_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def level_matches(spec: Levels) -> dict[str, Column]:
    return {f"match_L{i + 1}": match_lenient(p, t) for i, (p, t) in enumerate(zip(spec.pred, spec.truth))}


def combined_matches(spec: Levels) -> dict[str, Column]:
    """Combinations of the per-level matches, as expressions over the match columns."""
    parts = [F.col(f"match_L{i + 1}") for i in range(spec.depth)]
    out = {"partial_match_L1L2": all_of(parts[:2]), "partial_match_L1L2L3": all_of(parts[:3])}
    if spec.decisive < spec.depth:
        out["canonical_match"] = all_of(parts[: spec.decisive])
        out["full_match"] = all_of(parts)
    out["exact_match"] = all_of(parts[: spec.decisive])
    return out


def match_names(spec: Levels) -> list[str]:
    return [*level_matches(spec), *combined_matches(spec)]


def with_matches(df: DataFrame, spec: Levels) -> DataFrame:
    """Add all match columns; each level is compared once and the combinations look at the result."""
    return df.withColumns(level_matches(spec)).withColumns(combined_matches(spec))


def first_miss(spec: Levels) -> Column:
    """Label of the first wrong decisive level, from the match columns; null when all are right."""
    label = F.lit(None).cast("string")
    for position in reversed(range(len(spec.misses))):
        label = F.when(~F.col(f"match_L{position + 1}"), F.lit(spec.misses[position])).otherwise(label)
    return label


def informational_miss(spec: Levels) -> Column:
    """``MISMATCH L4+L5`` for levels behind the decisive ones."""
    wrong = [
        F.when(~F.col(f"match_L{i + 1}"), F.lit(f"L{i + 1}")) for i in range(spec.decisive, spec.depth)
    ]
    joined = F.concat_ws("+", *wrong)
    return F.when(joined != "", F.concat(F.lit("MISMATCH "), joined))


def layer_name(layer: Column | str) -> Column:
    col = F.col(layer) if isinstance(layer, str) else layer
    name = F.lit(None).cast("string")
    for number, text in LAYER_NAMES.items():
        name = F.when(col == number, F.lit(text)).otherwise(name)
    return name
