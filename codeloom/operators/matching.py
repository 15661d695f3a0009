"""Predictions against truth: unique truth lookup and any-mapping comparison."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from codeloom.functions.levels import Levels
from codeloom.functions.text import NULL_MARK, canon, strip

# Truth paths of a code that one bitmap word holds.
WORD = 64


def supported_lob(truth: DataFrame, column: str, valid: Sequence[str]) -> DataFrame:
    """Truth rows with no line of business or a supported one."""
    lob = F.lower(strip(column))
    return truth.filter(lob.isNull() | lob.isin(*valid))


def unsupported_lob(truth: DataFrame, column: str, valid: Sequence[str]) -> DataFrame:
    """The complement of ``supported_lob``."""
    return truth.filter(~F.lower(strip(column)).isin(*valid))


def truth_profile(truth: DataFrame, code: str, spec: Levels, extra: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per code: number of distinct paths and, for single-path codes, that path.

    ``extra`` columns (a description, say) come from the first row in ``order``, which must be total.
    """
    kept = F.struct(*spec.truth, *extra)
    first = F.min_by(kept, F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(order)]))
    profile = truth.groupBy(code).agg(
        F.count_distinct(F.struct(*spec.truth)).alias("n_mappings"), first.alias("_first")
    )
    single = F.col("n_mappings") == 1
    return profile.select(
        code,
        "n_mappings",
        *[F.when(single, F.col(f"_first.{c}")).alias(c) for c in (*spec.truth, *extra)],
    )


def stated_columns(pairs: Sequence[tuple[str, str]]) -> dict[str, Column]:
    """Canonical predicted values as columns: each is computed once."""
    return {f"_p{i}": canon(p) for i, (p, _) in enumerate(pairs)}


def path_bitmaps(truth: DataFrame, code: str, columns: Sequence[str]) -> DataFrame:
    """Bitmap index of the distinct truth paths: per code and word of ``WORD`` paths, ``bits`` maps (level, value) to the paths that have it.

    A row holds one word, so no row grows with the paths of its code.
    """
    paths = truth.select(code, *[canon(c).alias(f"t{i}") for i, c in enumerate(columns)]).distinct()
    number = F.row_number().over(Window.partitionBy(code).orderBy(*[f"t{i}" for i in range(len(columns))])) - 1
    placed = paths.withColumn("number", number).withColumn("word", F.expr(f"number div {WORD}"))
    bit = F.expr(f"shiftleft(1L, number % {WORD})")
    entries = F.inline(F.array(*[F.struct(_entry(i, F.col(f"t{i}")).alias("entry")) for i in range(len(columns))]))
    sets = placed.select(code, "word", bit.alias("bit"), entries).groupBy(code, "word", "entry").agg(F.bit_or("bit").alias("paths"))
    return sets.groupBy(code, "word").agg(F.map_from_entries(F.collect_list(F.struct("entry", "paths"))).alias("bits"))


def _entry(level: int, value: Column) -> Column:
    return F.concat(F.lit(f"{level}:"), value)


def _largest_count(sets: Sequence[Column]) -> Column:
    """The largest number of ``sets`` that share a bit: they are added up bit by bit in binary planes, one plane a digit of all counts."""
    planes = [f"p{k}" for k in range(len(sets).bit_length())]

    def add(sums: Column, carry: Column) -> Column:
        out = []
        for p in planes:
            out.append(sums[p].bitwiseXOR(carry).alias(p))
            carry = sums[p].bitwiseAND(carry)
        return F.struct(*out)

    def largest(sums: Column) -> Column:
        left, best = F.lit(-1).cast("long"), F.lit(0)
        for k in reversed(range(len(planes))):
            now = left.bitwiseAND(sums[planes[k]])
            best = best + F.when(now != 0, 1 << k).otherwise(0)
            left = F.when(now != 0, now).otherwise(left)
        return best

    return F.aggregate(F.array(*sets), F.struct(*[F.lit(0).cast("long").alias(p) for p in planes]), add, largest)


def best_agreement(
    stated: DataFrame, truth: DataFrame, code: str, pairs: Sequence[tuple[str, str]], decisive: int, lenient: bool
) -> DataFrame:
    """Per code and stated path, the largest number of levels that agree with any one truth path of the
    code: ``best`` over the first ``decisive`` levels and ``best_all`` over all. ``stated`` holds the
    predictions with ``stated_columns``.

    Comparing each prediction with each path would emit all pairs of a code. Instead a stated path meets the code's bitmap words, ``WORD``
    paths at once: each level gives the set of paths that agree on it, and the sets are added up in binary planes. The work does
    not grow with the subsets of levels. With ``lenient``, an empty truth level always agrees.
    """
    path = [f"_p{i}" for i in range(len(pairs))]
    index = path_bitmaps(truth, code, [t for _, t in pairs])
    met = stated.select(code, *path).distinct().join(index, code)

    def agreeing(i: int) -> Column:
        own = F.coalesce(F.try_element_at("bits", _entry(i, F.col(path[i]))), F.lit(0))
        open_ = F.coalesce(F.try_element_at("bits", F.lit(f"{i}:{NULL_MARK}")), F.lit(0))
        return own.bitwiseOR(open_) if lenient else own

    sets = [agreeing(i) for i in range(len(pairs))]
    return met.groupBy(code, *path).agg(F.max(_largest_count(sets[:decisive])).alias("best"), F.max(_largest_count(sets)).alias("best_all"))


def with_agreement(
    pred: DataFrame, truth: DataFrame, spec: Levels, code: str, lenient: bool | None = None, only: Column | None = None
) -> DataFrame:
    """Predictions with the best agreement and the any-match flags; a code without truth left gets zero
    and false. With ``only``, other rows are not looked at and their flags mean nothing."""
    lenient = spec.lenient_any if lenient is None else lenient
    pairs = list(zip(spec.pred, spec.truth))
    columns = stated_columns(pairs)
    stated = pred.withColumns(columns)
    looked_at = stated if only is None else stated.filter(only)
    best = best_agreement(looked_at, truth, code, pairs, spec.decisive, lenient)
    flags = {
        "best_levels_matched": F.coalesce("best", F.lit(0)),
        "exact_match_any": F.coalesce(F.col("best") == spec.decisive, F.lit(False)),
    }
    if spec.decisive < spec.depth:
        flags["full_match_any"] = F.coalesce(F.col("best_all") == spec.depth, F.lit(False))
    return stated.join(best, [code, *columns], "left").withColumns(flags).drop("best", "best_all", *columns)


def valid_mappings(pred: DataFrame, truth: DataFrame, code: str, shown: Sequence[str]) -> DataFrame:
    """Distinct truth rows of the codes in ``pred``, for display next to an ambiguous prediction."""
    return truth.join(pred.select(code).distinct(), code, "left_semi").select(code, *shown).distinct()
