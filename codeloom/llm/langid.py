"""Language identification by cross-parsing: texts are cut into the longest phrases that a language's training text holds.

A suffix automaton of labelled text per language tells how far a phrase goes on. A text in that language needs few phrases. After
Ziv and Merhav, phrases * log2(training length) / letters estimates the cross-entropy; the language with the smallest wins.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from codeloom.llm.arrowtext import code_points, pieces
from codeloom.llm.tables import Shared, Store, bounded_side, read_table

# The bound of the training sample of a language: documents, and letters taken from each at a place that its doc_id's hash names.
SAMPLE_DOCS, SAMPLE_LETTERS = 80, 400
# All languages together train on at most so many letters; with many languages each gets less.
TOTAL_LETTERS = 400_000
# Letters are parsed in blocks of this length, many blocks side by side; a phrase ends with its block.
BLOCK = 512
# Bytes of text parsed at once.
PARSE_BYTES = 4_000_000
UNDETERMINED = "und"
FOLDS, HELD_OUT = 5, 0

PAD, UNKNOWN = 0, 1
# Numbers of code points in Unicode.
CODE_POINTS = 0x110000


def letters_of(text: str) -> str:
    """The text in lower case with every run of other characters than letters as one space."""
    return " ".join("".join(c if c.isalpha() else " " for c in text.lower()).split())


def suffix_automaton(text: str) -> tuple[list[dict[str, int]], int]:
    """Transitions of the suffix automaton, which accepts every substring of ``text``, and the number of states. State 0 starts."""
    following: list[dict[str, int]] = [{}]
    link, length, last = [-1], [0], 0
    for letter in text:
        new = len(following)
        following.append({})
        length.append(length[last] + 1)
        link.append(0)
        at = last
        while at != -1 and letter not in following[at]:
            following[at][letter] = new
            at = link[at]
        if at != -1:
            there = following[at][letter]
            if length[there] == length[at] + 1:
                link[new] = there
            else:
                copy = len(following)
                following.append(dict(following[there]))
                length.append(length[at] + 1)
                link.append(link[there])
                link[there] = link[new] = copy
                while at != -1 and following[at].get(letter) == there:
                    following[at][letter] = copy
                    at = link[at]
        last = new
    return following, len(following)


def training_text(rows: pd.DataFrame, most: int) -> str:
    """Letters of the sampled texts: of each a stretch that begins where the hash of its doc_id points, round the end if need be."""
    taken, size = [], 0
    for text, place in zip(rows["text"], rows["place"]):
        letters = letters_of(text)
        if letters and size < most:
            at = int(place) % len(letters)
            stretch = (letters[at:] + " " + letters[:at])[:min(SAMPLE_LETTERS, most - size)]
            taken.append(stretch)
            size += len(stretch)
    return " ".join(taken)


def _train(most: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        text = training_text(rows.sort_values(["place", "text"]), most)
        following, _ = suffix_automaton(text)
        steps = [(state, letter, target) for state, row in enumerate(following) for letter, target in row.items()]
        return pd.DataFrame({
            "lang": [rows["lang"].iloc[0]], "size": [len(text)], "states": [len(following)],
            "letters": ["".join(s[1] for s in steps)],
            "steps": [np.array([(s[0], s[2]) for s in steps], np.int32).tobytes()],
        })

    return run


@dataclass
class Languages:
    """Per language its name, log2 of its training length, and its automaton as a flat table over a common alphabet.

    Row r of a table is state r - 1, row 0 means none, and the last row is left by no letter; values are row starts. In column PAD
    every state stays; column UNKNOWN, of letters that no training text holds, has no steps.
    """

    names: list[str]
    tables: list[np.ndarray]
    logs: list[float]
    column_of: np.ndarray  # by code point; 0 for what is no letter
    space: int
    width: int


def combine(trained: list) -> Languages:
    """From rows (lang, size, states, letters, steps)."""
    alphabet = sorted({" "}.union(*(r["letters"] for r in trained)))
    column = {c: i + 2 for i, c in enumerate(alphabet)}
    width = len(alphabet) + 2
    tables = []
    for row in trained:
        table = np.zeros((row["states"] + 2, width), np.int32)
        table[:, PAD] = np.arange(row["states"] + 2) * width
        steps = np.frombuffer(row["steps"], np.int32).reshape(-1, 2)
        table[steps[:, 0] + 1, [column[c] for c in row["letters"]]] = (steps[:, 1] + 1) * width
        tables.append(table.ravel())
    columns = np.zeros(CODE_POINTS, np.uint16)
    for code in range(CODE_POINTS):
        letter = chr(code)
        if letter.isalpha():
            columns[code] = column.get(letter.lower()[0], UNKNOWN)
    return Languages([r["lang"] for r in trained], tables, [math.log2(r["size"] + 1) for r in trained], columns, column[" "], width)


def phrases(blocks: np.ndarray, table: np.ndarray, width: int) -> np.ndarray:
    """How many phrases every column of ``blocks`` (letters down, blocks across) is cut into; an unknown letter is one of its own."""
    first = table[width:2 * width].astype(np.int64)
    first[first == 0] = len(table) - width
    state = first[blocks[0]]
    count = np.ones(blocks.shape[1], np.int64)
    for letters in blocks[1:]:
        state = table[state + letters].astype(np.int64)
        ended = state == 0
        count += ended
        np.copyto(state, first[letters], where=ended)
    return count


def blocks_of(column: pa.Array, languages: Languages) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Blocks of letters (padded), the first block of every text (one more than texts), and every text's number of letters.

    Only letters are kept, and one space where other characters stood between them.
    """
    codes, starts = code_points(column)
    found = languages.column_of[codes]
    letter = found > 0
    kept = letter.copy()
    kept[1:] |= letter[:-1]
    heads = starts[:-1][starts[:-1] < len(codes)]
    kept[heads] = letter[heads]
    before = np.zeros(len(codes) + 1, np.int64)
    np.cumsum(letter, out=before[1:])
    count = np.diff(before[starts])
    place = np.zeros(len(codes) + 1, np.int64)
    np.cumsum(kept, out=place[1:])
    found = np.where(letter, found, languages.space)[kept]
    firsts = place[starts]
    sizes = np.diff(firsts)
    first_block = np.zeros(len(starts), np.int64)
    np.cumsum(-(-sizes // BLOCK), out=first_block[1:])
    rank = np.arange(len(found)) - np.repeat(firsts[:-1], sizes)
    blocks = np.full((BLOCK, first_block[-1]), PAD, np.int64)
    blocks[rank % BLOCK, np.repeat(first_block[:-1], sizes) + rank // BLOCK] = found
    return blocks, first_block, count


def judge(column: pa.Array, languages: Languages) -> tuple[list[str], np.ndarray]:
    """The language of every text, and as score the runner-up's entropy over the sum of both: 0.5 undecided, 1 sure, 0 for
    texts without a letter. Ties go to the language first in order."""
    blocks, first_block, letters = blocks_of(column, languages)
    texts = len(column)
    if not languages.names:
        return [UNDETERMINED] * texts, np.zeros(texts)
    entropy = np.zeros((len(languages.names), texts))
    for i, (table, log) in enumerate(zip(languages.tables, languages.logs)):
        sums = np.zeros(blocks.shape[1] + 1, np.int64)
        np.cumsum(phrases(blocks, table, languages.width), out=sums[1:])
        entropy[i] = np.diff(sums[first_block]) * log / np.maximum(1, letters)
    best = entropy.argmin(axis=0)
    ordered = np.sort(entropy, axis=0)
    second = ordered[1] if len(ordered) > 1 else np.full(texts, np.inf)
    with np.errstate(invalid="ignore", divide="ignore"):
        share = np.where(np.isinf(second), 1.0, second / (ordered[0] + second))
    named = [languages.names[b] if n else UNDETERMINED for b, n in zip(best, letters)]
    return named, np.where(letters > 0, share, 0.0)


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % FOLDS == HELD_OUT, F.lit(False))


def learn(docs: DataFrame) -> Languages:
    """From text and lang of rows that are not held out; rows without a doc_id, a language or a letter teach nothing."""
    store = Store(docs.sparkSession, "languages")
    known = docs.filter("doc_id is not null and lang is not null").filter(~held_out()).filter(F.col("text").rlike(r"\p{L}"))
    order = Window.partitionBy("lang").orderBy("place", "doc_id")
    drawn = store.keep(
        known.select("doc_id", "lang", F.xxhash64("doc_id").alias("place"))
        .withColumn("n", F.row_number().over(order)).filter(F.col("n") <= SAMPLE_DOCS).select("doc_id", "lang", "place")
    )
    count = drawn.select("lang").distinct().count()
    sample = known.select("doc_id", "lang", "text").join(bounded_side(drawn), ["doc_id", "lang"])
    trained = sample.withColumn("place", F.expr("place & 9223372036854775807")).groupBy("lang").applyInPandas(
        _train(min(SAMPLE_DOCS * SAMPLE_LETTERS, TOTAL_LETTERS // max(1, count))),
        "lang string, size long, states long, letters string, steps binary",
    ).filter("size > 0").orderBy("lang").collect()
    return combine(trained)


def identify(docs: DataFrame, languages: Languages, lang_as: str = "lang_pred", score_as: str = "score") -> DataFrame:
    """The columns of ``docs`` with the predicted language and a score (0 to 1); columns of their names are replaced.

    A null text or one without a letter is undetermined. Every row is judged by its whole text alone, and stays where it is.
    """
    docs = docs.drop(lang_as, score_as)
    fields = [T.StructField(lang_as, T.StringType()), T.StructField(score_as, T.DoubleType())]
    shared = Shared(docs.sparkSession, languages)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.get()
        for batch in batches:
            for part in pieces(batch, "text", PARSE_BYTES):
                named, share = judge(part.column("text"), own)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(named, pa.string()), pa.array(share)], names=[*part.schema.names, lang_as, score_as],
                )

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, *fields]))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return identify(docs.select("doc_id", "text"), learn(docs)).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
