"""Near-duplicate texts: fast similarity sketching, banding, and verification on whole shingle sets.

The sketch follows Dahlgaard, Knudsen and Thorup, "Fast Similarity Sketching" (FOCS 2017). Of t coordinates, round i < t throws
every shingle of a set into one random bin with a value in [i, i + 1); round t + j throws all of them into bin j. A coordinate is
the smallest value its bin got, so the rounds can end as soon as no bin is empty: about one round for a set of t ln t shingles,
and every coordinate is filled after 2t rounds at the latest. Two sets agree in a coordinate with probability equal to their
Jaccard similarity, and the share of equal coordinates is concentrated around it as for independent hash functions.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from codeloom.llm.arrowtext import mix, pieces, random_numbers
from codeloom.llm.buckets import Side, classes_of_buckets
from codeloom.llm.shingles import shingle_sets
from codeloom.llm.tables import Store, read_table, text_mark, without

WORDS = 5
SIMILARITY_PERCENT = 75
# A pair at the threshold misses all bands with probability (1 - 0.75 ** 5) ** 48 = 2.3e-6.
BANDS, ROWS = 48, 5
# Coordinates of a sketch. The bands take the first BANDS * ROWS; all of them tell how far two sketches agree.
COORDINATES = 1024
# Two bits of every coordinate are kept for that, 32 coordinates in a number.
_BITS, _PER_NUMBER, _EVEN = 2, 32, 0x5555555555555555
# A pair at the threshold agrees less than asked for with a probability of 3e-7: so many standard deviations below its mean.
DEVIATIONS = 5.0


def sketches(values: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
    """One row of ``size`` coordinates per set (a row of the highest number for an empty set)."""
    sets, unfilled = len(starts) - 1, np.iinfo(np.uint64).max
    out = np.full((sets, size), unfilled, np.uint64)
    flat = out.reshape(-1)
    seeds = random_numbers(2 * size, 211)
    owner = np.repeat(np.arange(sets), np.diff(starts))
    active = np.flatnonzero(np.diff(starts))
    for i in range(2 * size):
        if not len(active):
            break
        thrown = mix(values ^ seeds[i])
        place = ((thrown >> np.uint64(32)) * np.uint64(size) >> np.uint64(32)).astype(np.int64) if i < size else i - size
        np.minimum.at(flat, owner * size + place, (np.uint64(i) << np.uint64(32)) | (thrown & np.uint64(0xFFFFFFFF)))
        # Rounds after the last empty bin change nothing, so it is enough to look now and then.
        if i < 16 or i % 16 == 0:
            waiting = (out[active] == unfilled).any(axis=1)
            if not waiting.all():
                active = active[waiting]
                still = np.zeros(sets, bool)
                still[active] = True
                values, owner = values[still[owner]], owner[still[owner]]
    return out


def _sketch_batches(words: int, bands: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "text"):
                values, starts = shingle_sets(part.column("text"), words)
                marks = []
                for seed in (307, 311):
                    sums = np.zeros(len(values) + 1, np.uint64)
                    np.cumsum(mix(values ^ random_numbers(1, seed)[0]), out=sums[1:])
                    marks.append((sums[starts[1:]] - sums[starts[:-1]]).view(np.int64))
                made = mix(sketches(values, starts, COORDINATES))
                factors = random_numbers(rows, 503) | np.uint64(1)
                keys = mix((made[:, :bands * rows].reshape(-1, bands, rows) * factors).sum(axis=2) + random_numbers(bands, 509))
                shifts = np.arange(_PER_NUMBER, dtype=np.uint64) * np.uint64(_BITS)
                low = (made & np.uint64(2 ** _BITS - 1)).reshape(len(made), -1, _PER_NUMBER)
                agree = (low << shifts).sum(axis=2)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("mark"), pa.array(np.diff(starts)), pa.array(marks[0]), pa.array(marks[1]), _lists(keys), _lists(agree)],
                    names=["doc_id", "mark", "n_shingles", "mark1", "mark2", "bands", "sketch"],
                )

    return run


def _lists(numbers: np.ndarray) -> pa.Array:
    rows, width = numbers.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(rows + 1, dtype=np.int32) * width), pa.array(numbers.reshape(-1).view(np.int64)))


def least_agreement(percent: int) -> int:
    """In how many coordinates two sketches have to agree to be compared: DEVIATIONS below the mean of a pair at the threshold.
    Different coordinates still agree in their kept bits by chance."""
    share = percent / 100
    p = share + (1 - share) / 2 ** _BITS
    return int(COORDINATES * p - DEVIATIONS * (COORDINATES * p * (1 - p)) ** 0.5)


def _plausible(left: Side, right: Side, percent: int) -> Column:
    """Enough coordinates agree, and the bucket is that of the first band that both share: a pair is emitted once, not per band."""
    shared = F.filter(F.zip_with(left("bands"), right("bands"), lambda x, y: F.when(x == y, x)), lambda x: x.isNotNull())
    return _agreeing(left("sketch"), right("sketch"), percent) & (F.get(shared, F.lit(0)) == left("key"))


def _agreeing(left: Column, right: Column, percent: int) -> Column:
    def differing(x: Column, y: Column) -> Column:
        apart = x.bitwiseXOR(y)
        return F.bit_count(apart.bitwiseOR(F.shiftrightunsigned(apart, 1)).bitwiseAND(F.lit(_EVEN)))

    total = F.aggregate(F.zip_with(left, right, differing), F.lit(0), lambda n, x: n + x)
    return total <= COORDINATES - least_agreement(percent)


def _confirm_batches(words: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for half in pieces(batch, "text_a"):
                for part in pieces(half, "text_b"):
                    sides = []
                    for side in "ab":
                        ids = part.column(side).to_numpy(zero_copy_only=False)
                        _, first, where = np.unique(ids, return_index=True, return_inverse=True)
                        values, starts = shingle_sets(part.column(f"text_{side}").take(pa.array(first)), words)
                        sides.append([values[starts[w]:starts[w + 1]] for w in where])
                    good = np.zeros(part.num_rows, bool)
                    for i, (x, y) in enumerate(zip(*sides)):
                        common = len(np.intersect1d(x, y, assume_unique=True))
                        good[i] = 100 * common >= percent * (len(x) + len(y) - common) and common > 0
                    yield part.select(["a", "b"]).filter(pa.array(good))

    return run


def near_duplicates(
    docs: DataFrame, percent: int = SIMILARITY_PERCENT, words: int = WORDS, bands: int = BANDS, rows: int = ROWS,
) -> DataFrame:
    """Columns doc_id, n_shingles, component_id and kept, one row per row of ``docs`` (columns doc_id and text; others are ignored).

    Texts with equal sets (128-bit marks) are one class before anything is paired. Classes that share a band, and whose sketches
    do not rule it out, are compared on their whole sets: linked if 100 * intersection >= percent * union. component_id is the smallest doc_id that can be reached.

    A null, empty or blank text has no shingles and no links. Rows that repeat a doc_id with the same text get the same answer;
    classes whose smallest doc_id is the same count as linked. Rows without a doc_id take the component of equal texts, if any,
    and link nothing. An empty table gives an empty result.
    """
    return _judged(docs, percent, words, bands, rows).drop("mark")


def _judged(docs: DataFrame, percent: int = SIMILARITY_PERCENT, words: int = WORDS, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """As ``near_duplicates``, with the ``text_mark`` of every row."""
    spark = docs.sparkSession
    store = Store(spark, "near")
    sketched = store.keep(docs.select("doc_id", "text", text_mark().alias("mark")).mapInArrow(
        _sketch_batches(words, bands, rows),
        "doc_id long, mark long, n_shingles long, mark1 long, mark2 long, bands array<long>, sketch array<long>",
    ))
    equal = ["n_shingles", "mark1", "mark2"]
    classes = store.keep(
        sketched.filter("n_shingles > 0").groupBy(*equal)
        .agg(F.min("doc_id").alias("node"), F.max("bands").alias("bands"), F.max("sketch").alias("sketch"))
    )
    known = classes.filter("node is not null")
    buckets = known.select(
        F.explode("bands").alias("key"), "node", F.col("n_shingles").alias("size"), F.lit(True).alias("indexed"),
    )
    # Classes with the same smallest doc_id share a node, which then has no details of its own.
    alone = known.groupBy("node").agg(F.count("*").alias("n"), F.max(F.struct("bands", "sketch")).alias("d"))
    details = alone.filter("n = 1").select("node", "d.*")
    grouped, _ = classes_of_buckets(
        buckets, lambda m, n: 100 * F.least(m, n) >= percent * F.greatest(m, n),
        lambda pairs: _confirmed(pairs, docs, words, percent, store), store,
        details, lambda x, y: _plausible(x, y, percent),
    )
    labelled = classes.drop("bands", "sketch").join(grouped, "node", "left").select(
        *equal, F.coalesce("component", "node").alias("component"),
    )
    component = F.when(F.col("n_shingles") > 0, F.coalesce("component", "doc_id")).otherwise(F.col("doc_id"))
    return sketched.drop("bands", "sketch").join(labelled, equal, "left").select(
        "doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"), "mark",
    )


def _confirmed(pairs: DataFrame, docs: DataFrame, words: int, percent: int, store: Store) -> DataFrame:
    """Those of the pairs whose whole sets are similar enough. The texts of all documents move once, those of pairs once per pair."""
    wanted = store.keep(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct())
    texts = store.keep(docs.select("doc_id", "text").join(wanted, "doc_id").groupBy("doc_id").agg(F.min("text").alias("text")))
    met = pairs.join(texts.toDF("a", "text_a"), "a").join(texts.toDF("b", "text_b"), "b")
    return met.mapInArrow(_confirm_batches(words, percent), "a long, b long")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near copies: the one with the smallest doc_id.

    Every row is judged by itself: of a doc_id that occurs with several texts each stays or goes on its own, and rows without a doc_id go
    if a document with one has an equal text. Texts without words stay. An empty table stays empty; all columns stay.
    """
    return without(docs, _judged(docs).filter("not kept"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read_table(spark, sf_dir, "documents"))


SQL = """
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
    ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) END) AS g FROM w),
n AS (SELECT w.doc_id, count(s.g) AS n FROM w LEFT JOIN s ON s.doc_id = w.doc_id GROUP BY w.doc_id),
p AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY 1, 2),
e AS (
  SELECT a, b FROM p JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * k >= 75 * (na.n + nb.n - k)),
r(a, b) AS (SELECT doc_id, doc_id FROM n UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a)
SELECT n.doc_id, n.n AS n_shingles, c.component_id, n.doc_id = c.component_id AS kept
FROM n JOIN (SELECT a, min(b) AS component_id FROM r GROUP BY a) c ON c.a = n.doc_id
"""
