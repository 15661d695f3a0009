"""Toxicity: gradient-boosted trees over dense features, calibrated by isotonic regression.

Features of a text: densities of words that a lexicon learned from labelled texts holds (whole words, and families of words by
their first letters), how near they stand to second-person words, shares of capitals and of punctuation, and how often words are
obfuscated (digits or signs between letters). Lexicon, trees and calibration are fitted on three parts of a bounded sample.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from codeloom.llm.arrowtext import pieces
from codeloom.llm.tables import Shared, Store, bounded_side, read_table

THRESHOLD = 0.3
# The bound of the sample that everything is fitted on: rows of each label, those with the smallest hash of their doc_id.
SAMPLE_ROWS = 6_000
# Of every four sampled rows, two teach the lexicon, one the trees and one the calibration.
LEXICON_PARTS, TREE_PART, CALIBRATION_PART, PARTS = (0, 1), 2, 3, 4
# Families of words share their first letters; a stem is shorter than its word.
STEMS = (4, 5, 6)
# A term enters the lexicon if so many toxic texts hold it, its log odds are so high, and the signed root of its likelihood ratio.
LEAST_TEXTS, LEAST_ODDS, LEAST_ROOT = 3, 2.0, 4.0
# The bound of what is sent to every task.
LEXICON_TERMS = 20_000
# Rows that a task hands over at once.
TERMS_AT_ONCE = 50_000
# The sample is a few thousand rows; every level of every tree is a job over it, so it lies in few partitions.
FITTING_TASKS = 4
NEAR_WORDS = 5
TREES, DEPTH, STEP = 20, 4, 0.2
FOLDS, HELD_OUT = 4, 2

# Second-person words of English, French, German and Spanish.
SECOND_PERSON = frozenset(
    "you your yours yourself yourselves tu te toi ton ta tes vous votre vos du dich dir dein deine deinen deiner euch euer eure "
    "sie ihr ihnen tú ti usted ustedes vosotros vuestro vuestra tuyo tuya".split()
)
# Digits and signs that stand for letters.
STAND_INS = str.maketrans("013457@$!|", "oieastasii")

FEATURES = [
    "lexicon_rate", "lexicon_hits", "lexicon_weight", "lexicon_top", "stem_rate", "stem_hits", "disguised_hits",
    "second_person_rate", "near_second_person", "capital_rate", "shouted_rate", "punctuation_rate", "exclamation_rate",
    "obfuscation_rate", "mean_word", "log_words",
]

_LETTERS = re.compile(r"[^\W\d_]+")
_OBFUSCATED = re.compile(r"[^\W\d_]+(?:[0-9@$!|*._-]+[^\W\d_]+)+")
_CAPITAL = re.compile(r"[A-ZÀ-ÖØ-Þ]")
_SHOUTED = re.compile(r"\b[A-ZÀ-ÖØ-Þ]{3,}\b")
_PUNCTUATION = re.compile(r"[!-/:-@\[-`{-~]")


def text_terms(text: str | None) -> set[str]:
    """The distinct words of a text in lower case, and their stems, which end in a star."""
    words = set(_LETTERS.findall((text or "").lower()))
    return words.union(*({w[:n] + "*" for w in words if len(w) > n} for n in STEMS))


@dataclass
class Lexicon:
    """Log odds of words and of stems."""

    words: dict[str, float] = field(default_factory=dict)
    stems: dict[str, float] = field(default_factory=dict)

    def __post_init__(self) -> None:
        self.heads = {term[:STEMS[0]] for term in (*self.words, *self.stems)}

    def weight(self, word: str) -> tuple[float, bool]:
        """The log odds of a word, else of its longest known stem, and whether it was a stem; zero if neither is known."""
        if word in self.words:
            return self.words[word], False
        for n in reversed(STEMS):
            if len(word) > n and word[:n] in self.stems:
                return self.stems[word[:n]], True
        return 0.0, False

    def features(self, text: str | None) -> list[float]:
        """The values of FEATURES; zeros for a null, empty or blank text."""
        if not text or text.isspace():
            return [0.0] * len(FEATURES)
        words = _LETTERS.findall(text.lower())
        found = [(i, *self.weight(w)) for i, w in enumerate(words) if w[:STEMS[0]] in self.heads]
        hits = [(i, weight, stem) for i, weight, stem in found if weight]
        stems = sum(stem for _, _, stem in hits)
        persons = [i for i, w in enumerate(words) if w in SECOND_PERSON]
        near = sum(any(abs(i - j) <= NEAR_WORDS for j in persons) for i, _, _ in hits) if len(persons) < 50 else _near(hits, persons)
        odd = _OBFUSCATED.findall(text)
        plain = ("".join(_LETTERS.findall(token.lower().translate(STAND_INS))) for token in odd)
        disguised = sum(self.weight(word)[0] > 0 for word in plain)
        n, letters, size = max(1, len(words)), max(1, sum(map(len, words))), len(text)
        return [
            len(hits) / n, float(len(hits)), sum(w for _, w, _ in hits) / n, max((w for _, w, _ in hits), default=0.0),
            stems / n, float(stems), float(disguised), len(persons) / n, near / n, len(_CAPITAL.findall(text)) / letters,
            len(_SHOUTED.findall(text)) / n, len(_PUNCTUATION.findall(text)) / size, text.count("!") / size, len(odd) / n,
            letters / n, math.log1p(len(words)),
        ]


def _near(hits: list[tuple], persons: list[int]) -> int:
    """How many hits have a second-person word near, in one walk along both."""
    near = j = 0
    for i, _, _ in hits:
        while j < len(persons) and persons[j] < i - NEAR_WORDS:
            j += 1
        near += j < len(persons) and persons[j] <= i + NEAR_WORDS
    return near


@dataclass
class Model:
    """What was fitted; without trees, the sample lacked a label and every score is ``base``."""

    lexicon: Lexicon
    trees: GBTClassificationModel | None
    curve: IsotonicRegressionModel | None
    base: float


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % FOLDS == HELD_OUT, F.lit(False))


def _count_terms(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """How many toxic and clean texts of one partition of the bounded sample hold each term."""
    counts: tuple[Counter, Counter] = (Counter(), Counter())
    for batch in batches:
        for text, toxic in zip(batch["text"], batch["toxic"]):
            counts[int(toxic)].update(text_terms(text))
    terms = list(counts[0] | counts[1])
    for at in range(0, len(terms), TERMS_AT_ONCE):
        part = terms[at:at + TERMS_AT_ONCE]
        yield pd.DataFrame({"term": part, "clean": [counts[0][t] for t in part], "toxic": [counts[1][t] for t in part]})


def learn_lexicon(sample: DataFrame) -> Lexicon:
    """Terms that toxic texts of the bounded sample (columns text, toxic) hold significantly more often than clean ones."""
    sizes = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    clean_n, toxic_n = sizes.get(0, 0), sizes.get(1, 0)
    if not clean_n or not toxic_n:
        return Lexicon()
    counted = (
        sample.select("text", "toxic").mapInPandas(_count_terms, "term string, clean long, toxic long")
        .groupBy("term").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")).filter(F.col("toxic") >= LEAST_TEXTS)
    )

    def fit(k: Column, n: int, share: Column) -> Column:
        return F.when(k > 0, k * F.log(share)).otherwise(0) + F.when(k < n, (n - k) * F.log(1 - share)).otherwise(0)

    t, c, both = F.col("toxic"), F.col("clean"), toxic_n + clean_n
    shared = (t + c) / both
    ratio = 2 * (fit(t, toxic_n, t / toxic_n) + fit(c, clean_n, c / clean_n) - fit(t, toxic_n, shared) - fit(c, clean_n, shared))
    odds = F.log((t + 0.5) / (toxic_n - t + 0.5)) - F.log((c + 0.5) / (clean_n - c + 0.5))
    kept = (
        counted.select("term", odds.alias("odds"), F.sqrt(F.greatest(ratio, F.lit(0.0))).alias("root"))
        .filter((F.col("odds") >= LEAST_ODDS) & (F.col("root") >= LEAST_ROOT))
        .orderBy(F.desc("root"), "term").limit(LEXICON_TERMS).collect()
    )
    words = {r["term"]: r["odds"] for r in kept if not r["term"].endswith("*")}
    return Lexicon(words, {r["term"][:-1]: r["odds"] for r in kept if r["term"].endswith("*")})


def _with_features(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """All columns and a vector _features; rows stay where they are."""
    schema = T.StructType([*docs.schema.fields, T.StructField("_list", T.ArrayType(T.DoubleType()))])
    shared = Shared(docs.sparkSession, lexicon)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.get()
        for batch in batches:
            for part in pieces(batch, "text"):
                values = [own.features(text) for text in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(values, pa.list_(pa.float64()))], names=[*part.schema.names, "_list"],
                )

    return docs.mapInArrow(run, schema).withColumn("_features", array_to_vector("_list")).drop("_list")


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model:
    """Fitted on labelled rows that are not held out. Rows of ``labels`` without doc_id or a label of 0 or 1 teach nothing."""
    store = Store(docs.sparkSession, "toxicity")
    known = labels.filter("doc_id is not null and toxic in (0, 1)").filter(~held_out()).select("doc_id", "toxic").distinct()
    totals = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    base = totals.get(1, 0) / max(1, sum(totals.values()))
    drawn = [known.filter(F.col("toxic") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows) for label in (0, 1)]
    chosen = store.keep(drawn[0].unionByName(drawn[1]).withColumn("part", F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(PARTS))))
    sample = store.keep(docs.select("doc_id", "text").join(bounded_side(chosen), "doc_id").select("text", "toxic", "part"))
    lexicon = learn_lexicon(sample.filter(F.col("part").isin(*LEXICON_PARTS)))
    fitting = sample.filter(~F.col("part").isin(*LEXICON_PARTS)).coalesce(FITTING_TASKS)
    rows = store.keep(_with_features(fitting, lexicon).drop("text"))
    labelled = rows.withColumn("label", F.col("toxic").cast("double"))
    teaching, checking = labelled.filter(F.col("part") == TREE_PART), labelled.filter(F.col("part") == CALIBRATION_PART)
    present = {(r["part"], r["toxic"]) for r in rows.select("part", "toxic").distinct().collect()}
    if len(present) < 4:
        return Model(lexicon, None, None, base)
    trees = GBTClassifier(
        featuresCol="_features", labelCol="label", maxIter=TREES, maxDepth=DEPTH, stepSize=STEP, seed=1, minInstancesPerNode=5,
    ).fit(teaching)
    # The sample holds as many toxic as clean rows; weights give calibration the shares of all labelled rows again.
    drawn_n = {label: min(n, sample_rows) for label, n in totals.items()}
    weight = F.when(F.col("toxic") == 1, totals[1] / drawn_n[1]).otherwise(totals[0] / drawn_n[0])
    scored = _margins(checking, trees).withColumn("weight", weight)
    curve = IsotonicRegression(featuresCol="_margin", labelCol="label", weightCol="weight", predictionCol="_score").fit(scored)
    return Model(lexicon, trees, curve, base)


def _margins(rows: DataFrame, trees: GBTClassificationModel) -> DataFrame:
    named = trees.copy().setRawPredictionCol("_raw").setProbabilityCol("_share").setPredictionCol("_class")
    return named.transform(rows).withColumn("_margin", vector_to_array("_share")[1]).drop("_raw", "_share", "_class")


def score(docs: DataFrame, model: Model, score_as: str = "score", predicted_as: str = "predicted") -> DataFrame:
    """The columns of ``docs`` with a score (0 to 1) and a prediction (1 from THRESHOLD on); columns of their names are replaced.

    A null, empty or blank text is scored by its features, which are zero. Every row is judged by its text alone.
    """
    docs = docs.drop(score_as, predicted_as)
    if model.trees is None:
        done = docs.withColumn(score_as, F.lit(model.base))
    else:
        margins = _margins(_with_features(docs, model.lexicon), model.trees)
        shown = model.curve.transform(margins).drop("_features", "_margin")
        done = shown.withColumn(score_as, F.greatest(F.lit(0.0), F.least(F.lit(1.0), "_score"))).drop("_score")
    return done.withColumn(predicted_as, (F.col(score_as) >= THRESHOLD).cast("int"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that are not toxic.

    Every row is judged by its own text, whatever its doc_id; null and empty texts by features of zero. Repeated rows share their fate; an
    empty table stays empty, all columns stay.
    """
    model = fit(docs, read_table(spark, sf_dir, "labels"))
    return score(docs, model, "_toxic_score", "_toxic").filter("_toxic = 0").drop("_toxic_score", "_toxic")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit(docs, read_table(spark, sf_dir, "labels"))
    return score(docs, model).select("doc_id", held_out().alias("held_out"), "score", "predicted")
