"""Exact duplicates: counting quotient filters find the fingerprints that occur twice, their texts are compared byte by byte."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from codeloom.llm.quotient import QuotientFilter
from codeloom.llm.tables import Store, read_table, text_mark, without

# Rows whose fingerprints share one merged filter (about 9 bytes a distinct fingerprint). Slices follow the number of rows.
SLICE_ROWS = 2_000_000
# Every run of white space that is not one plain space already.
_SPACE_RUNS = r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+"


def normalized(text: str) -> Column:
    """Every run of white space as one space; null as the empty text."""
    return F.regexp_replace(F.coalesce(F.col(text), F.lit("")), _SPACE_RUNS, " ")


def _partition_filters(slice_bits: int):
    """One filter per slice of fingerprints for all rows of a partition. Fingerprints of a slice share their high bits."""
    bits = 64 - slice_bits

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [b.column(0).to_numpy(zero_copy_only=False).view(np.uint64) for b in batches]
        prints, counts = np.unique(np.concatenate(found) if found else np.zeros(0, np.uint64), return_counts=True)
        edges = np.searchsorted(prints, np.arange(1 << slice_bits, dtype=np.uint64) << np.uint64(bits)) if slice_bits else np.zeros(1, int)
        for part, (low, high) in enumerate(zip(edges, np.append(edges[1:], len(prints)))):
            if low < high:
                own = prints[low:high] & np.uint64((1 << bits) - 1)
                made = QuotientFilter.of_counts(own, counts[low:high], bits).to_bytes()
                yield pa.RecordBatch.from_arrays([pa.array([part], pa.int64()), pa.array([made], pa.binary())], names=["slice", "filter"])

    return run


def _merge_slice(slice_bits: int):
    bits = 64 - slice_bits

    def run(group: pd.DataFrame) -> pd.DataFrame:
        whole = QuotientFilter.merged([QuotientFilter.from_bytes(f) for f in group["filter"]], bits)
        prints, counts = whole.counts()
        part = int(group["slice"].iloc[0])
        full = prints + np.uint64((part << bits) & (2 ** 64 - 1))
        twice = counts > 1
        return pd.DataFrame({"print": full[twice].view(np.int64), "n": counts[twice]})

    return run


def repeated_prints(prints: DataFrame, column: str, rows: int, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """Columns print and n: the fingerprints that occur more than once, with their exact counts."""
    slice_bits = max(0, (max(1, rows) - 1) // slice_rows).bit_length()
    filters = prints.select(column).mapInArrow(_partition_filters(slice_bits), "slice long, filter binary")
    return filters.groupBy("slice").applyInPandas(_merge_slice(slice_bits), "print long, n long")


def exact_duplicates(docs: DataFrame, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """Columns doc_id, keep_id, group_size, kept and text_sha256, one row per row of ``docs`` (columns doc_id and text).

    Texts are equal if identical once every run of white space is one space; of equal texts the smallest doc_id stays. Null
    counts as the empty text, and empty texts are equal to one another. Repeated rows count each; all rows that carry the
    doc_id that stays are kept. Rows without a doc_id give way to those with one; in a group without any id all stay.
    """
    return _judged(docs, slice_rows).drop("mark")


def _judged(docs: DataFrame, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """As ``exact_duplicates``, with the ``text_mark`` of every row."""
    store = Store(docs.sparkSession, "exact")
    normal = docs.select("doc_id", normalized("text").alias("normal"), text_mark().alias("mark"))
    marked = normal.withColumn("print", F.xxhash64("normal"))
    slim = store.keep(marked.select("doc_id", "mark", "print", F.sha2("normal", 256).alias("text_sha256")))
    twice = store.keep(repeated_prints(slim, "print", slim.count(), slice_rows).select("print"))
    # Grouping by the text itself compares the bytes; copies of a task's rows shrink to one row before the shuffle.
    groups = (
        marked.join(twice, "print", "left_semi").groupBy("normal")
        .agg(F.min("doc_id").alias("low"), F.count("*").alias("size"))
        .select(F.xxhash64("normal").alias("print"), F.sha2("normal", 256).alias("text_sha256"), "low", "size")
    )
    keep = F.coalesce("low", "doc_id")
    return slim.join(groups, ["print", "text_sha256"], "left").select(
        "doc_id", keep.alias("keep_id"), F.coalesce("size", F.lit(1)).alias("group_size"),
        F.col("doc_id").eqNullSafe(keep).alias("kept"), "text_sha256", "mark",
    )


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of equal texts: the one with the smallest doc_id.

    Every row is judged by itself: of a doc_id that occurs with several texts those go that an earlier document holds, and rows without a
    doc_id go if a document with one holds their text. Repeated rows stay together. An empty table stays empty; all columns stay.
    """
    return without(docs, _judged(docs).filter("not kept"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(read_table(spark, sf_dir, "documents"))


SQL = """
WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g') AS x FROM documents),
g AS (SELECT x, min(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY x)
SELECT t.doc_id, g.keep_id, g.group_size, t.doc_id = g.keep_id AS kept, sha256(t.x) AS text_sha256 FROM t JOIN g ON t.x = g.x
"""
