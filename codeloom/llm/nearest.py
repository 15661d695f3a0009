"""Nearest neighbours of stated queries: a block matrix join of quantised vectors, surviving pairs recomputed, results merged by heaps.

Queries are dealt to bands and candidates to cells; every (band, cell) pair is one tile. In a tile, unit vectors are rounded to int8
codes. The product of two code matrices gives all cosines of the tile up to an error that is known for each pair: with unit vectors
u = a + e and v = b + f (a, b the decoded codes), ``|uv - ab| <= |e||b| + |a||f| + |e||f|``. Pairs whose upper bound reaches the k-th best
score that the query is sure of are recomputed from the original vectors in double precision, so nothing is lost to rounding.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from codeloom.llm.tables import Store, read_table

K = 5
QUERY_STEP = 50
# A band or a cell holds at most this many bytes of vectors, and a cell at least so many rows.
TILE_BYTES = 32_000_000
CELL_ROWS = 1024
# Queries whose products with a cell are looked at together, and pairs that are recomputed together.
SLICE_QUERIES = 256
SLICE_PAIRS = 1 << 18
# Beyond the error bounds, for the rounding of the bounds themselves.
SLACK = 1e-9
# Sums of int8 products below this many dimensions are exact in single precision.
EXACT_DIMENSIONS = 1024

_FOUND = "query_id long, vec_id long, score double"


def usable(vector: Column) -> Column:
    """Not null, not empty, all components finite, one of them not zero."""
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & ~odd & F.exists(vector, lambda x: x != 0)


def _matrix(column: pd.Series) -> np.ndarray:
    """Vectors as rows of doubles, each divided by a power of two so that no square overflows; cosines are unchanged by it."""
    rows = np.stack(column.to_numpy()).astype(np.float64)
    return np.ldexp(rows, -np.frexp(np.abs(rows).max(axis=1))[1][:, None])


class Codes:
    """int8 codes of unit vectors with what decoding them can be off by."""

    def __init__(self, rows: np.ndarray):
        unit = rows / np.sqrt((rows * rows).sum(axis=1))[:, None]
        scale = np.abs(unit).max(axis=1) / 127
        self.codes = np.rint(unit / scale[:, None]).astype(np.int8)
        self.scale = scale
        decoded = self.codes * scale[:, None]
        self.error = np.sqrt(((unit - decoded) ** 2).sum(axis=1))
        self.norm = np.sqrt((decoded ** 2).sum(axis=1))

    def products(self, low: int, high: int, other: Codes) -> tuple[np.ndarray, np.ndarray]:
        """Approximate cosines of rows low to high with all rows of the other side, and how far off each may be."""
        kind = np.float32 if self.codes.shape[1] <= EXACT_DIMENSIONS else np.float64
        tile = (self.codes[low:high].astype(kind) @ other.codes.T.astype(kind)).astype(np.float64)
        tile *= self.scale[low:high, None]
        tile *= other.scale
        off = self.error[low:high, None] * (other.norm + other.error) + self.norm[low:high, None] * other.error
        return tile, off + SLACK


def cosines(left: np.ndarray, right: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Cosines of row pairs in double precision, summed in the order of the components."""
    out = np.empty(len(i))
    for low in range(0, len(i), SLICE_PAIRS):
        a, b = left[i[low:low + SLICE_PAIRS]], right[j[low:low + SLICE_PAIRS]]
        dot, aa, bb = (np.zeros(len(a)) for _ in range(3))
        for d in range(a.shape[1]):
            dot += a[:, d] * b[:, d]
            aa += a[:, d] * a[:, d]
            bb += b[:, d] * b[:, d]
        out[low:low + SLICE_PAIRS] = np.clip(dot / np.sqrt(aa * bb), -1, 1)
    return out


def _first_of_each(group: np.ndarray, score: np.ndarray, number: np.ndarray, n: int) -> np.ndarray:
    """Where the n best rows of each group stand: largest score first, ties by the smaller number."""
    order = np.lexsort((number, -score, group))
    ordered = group[order]
    starts = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]]) if len(ordered) else np.zeros(0, int)
    rank = np.arange(len(ordered)) - np.repeat(starts, np.diff(np.r_[starts, len(ordered)]))
    return order[rank < n]


def _tile(k: int):
    def best(queries: pd.DataFrame, cell: pd.DataFrame) -> pd.DataFrame:
        """The k best of one dimension's candidates for each query. A candidate is a vector with the smallest ids that have it."""
        own = queries["query_id"].to_numpy()
        q, c = _matrix(queries["vector"]), _matrix(cell["vector"])
        held = np.array([len(x) for x in cell["ids"]])
        flat = np.concatenate(cell["ids"].to_numpy())
        begin = np.cumsum(held) - held
        first = flat[begin]
        # A vector that only the query has is no candidate of it.
        order = np.argsort(first)
        place = order[np.minimum(np.searchsorted(first[order], own), len(first) - 1)]
        lonely = (first[place] == own) & (held[place] == 1)
        left, right = Codes(q), Codes(c)
        parts = []
        for low in range(0, len(q), SLICE_QUERIES):
            high = min(low + SLICE_QUERIES, len(q))
            near, off = left.products(low, high, right)
            alone = low + np.flatnonzero(lonely[low:high])
            near[alone - low, place[alone]] = -np.inf
            sure = np.full(high - low, -np.inf)
            if len(c) > k:
                top = np.argpartition(-near, k - 1, axis=1)[:, :k]
                i, j = np.repeat(np.arange(low, high), k), top.ravel()
                exact = cosines(q, c, i, j)
                exact[np.isinf(near[i - low, j])] = -np.inf
                sure = exact.reshape(-1, k).min(axis=1)
            i, j = np.nonzero((near + off >= sure[:, None]) & (near > -np.inf))
            i += low
            score = cosines(q, c, i, j)
            # One more vector than asked for: one of them may begin with the query itself.
            lead = _first_of_each(i, score, first[j], k + 1)
            i, j, score = i[lead], j[lead], score[lead]
            wide = np.repeat(np.arange(len(i)), held[j])
            ids = flat[np.repeat(begin[j] - (np.cumsum(held[j]) - held[j]), held[j]) + np.arange(len(wide))]
            wide, ids = wide[ids != own[i[wide]]], ids[ids != own[i[wide]]]
            lead = _first_of_each(i[wide], score[wide], ids, k)
            parts.append(pd.DataFrame({"query_id": own[i[wide[lead]]], "vec_id": ids[lead], "score": score[wide[lead]]}))
        return pd.concat(parts)

    def run(queries: pd.DataFrame, cell: pd.DataFrame) -> pd.DataFrame:
        if not len(queries) or not len(cell):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        q_size, c_size = queries["vector"].map(len), cell["vector"].map(len)
        found = [best(queries[q_size == d], cell[c_size == d]) for d in q_size.unique() if (c_size == d).any()]
        return pd.concat(found) if found else pd.DataFrame({"query_id": [], "vec_id": [], "score": []})

    return run


def _merge(k: int, ranked: bool):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """A heap of the k best for each query; the root is the one to go next."""
        heaps: dict[int, list] = {}
        for frame in frames:
            for query, vec, score in zip(frame["query_id"].tolist(), frame["vec_id"].tolist(), frame["score"].tolist()):
                heap = heaps.setdefault(query, [])
                if len(heap) < k:
                    heapq.heappush(heap, (score, -vec))
                else:
                    heapq.heappushpop(heap, (score, -vec))
        rows = [
            (query, rank + 1, -vec, score)
            for query, heap in heaps.items() for rank, (score, vec) in enumerate(sorted(heap, reverse=True))
        ]
        out = pd.DataFrame(rows, columns=["query_id", "rank", "vec_id", "score"])
        yield out if ranked else out.drop(columns="rank")

    return run


def _numbers(n: int) -> Column:
    return F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long"))


def nearest(rows: DataFrame, is_query: Column, k: int = K, cell_rows: int = CELL_ROWS, tile_bytes: int = TILE_BYTES) -> DataFrame:
    """Columns query_id, rank, vec_id and score: each query's ``k`` nearest of ``rows`` (columns vec_id, embedding) by cosine.

    Exact: nearest first, ties to the smaller vec_id, all candidates if there are fewer than ``k``, never the query itself. Vectors that
    are null, empty, zero or hold null or non-finite components, and rows without a vec_id, take no part. Vectors are compared
    with those of as many components. Rows that share a vec_id are one row; the smallest of their vectors counts. Equal vectors are
    compared once and keep the k + 1 smallest of their ids, more than any query can return; so a vector that very many rows have costs no
    more than another. An empty table gives no rows; other columns are ignored.
    """
    store = Store(rows.sparkSession, "nearest")
    vector = F.col("embedding")
    known = rows.filter(F.col("vec_id").isNotNull() & usable(vector)).select(F.col("vec_id").cast("long").alias("vec_id"), vector.alias("vector"))
    vectors = store.keep(known.groupBy("vec_id").agg(F.min("vector").alias("vector")))
    copies = Window.partitionBy("vector").orderBy("vec_id")
    candidates = store.keep(
        vectors.withColumn("copy", F.row_number().over(copies)).filter(F.col("copy") <= k + 1)
        .groupBy("vector").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))
    )
    queries = vectors.withColumn("query_id", F.col("vec_id")).filter(is_query).select("query_id", "vector")
    n, wide = candidates.agg(F.count("*"), F.max(F.size("vector"))).first()
    fit = max(1, tile_bytes // (8 * (wide or 1)))
    slots = 4 * rows.sparkSession.sparkContext.defaultParallelism
    cells = -(-n // min(fit, max(cell_rows, n // slots))) or 1
    bands = -(-queries.count() // fit) or 1
    left = queries.withColumn("band", F.pmod(F.xxhash64("query_id"), F.lit(bands)))
    right = candidates.withColumn("cell", F.pmod(F.xxhash64(F.col("ids")[0]), F.lit(cells)))
    left = left.withColumn("cell", F.explode(_numbers(cells)))
    right = right.withColumn("band", F.explode(_numbers(bands)))
    found = left.groupBy("band", "cell").cogroup(right.groupBy("band", "cell")).applyInPandas(_tile(k), _FOUND)
    merged = found.mapInPandas(_merge(k, False), _FOUND).repartition("query_id")
    return merged.mapInPandas(_merge(k, True), "query_id long, rank int, vec_id long, score double")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % QUERY_STEP == 0)


SQL = """
WITH v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
p AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, list_cosine_similarity(q.e, c.e) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e) WHERE q.vec_id % 50 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS place FROM p)
SELECT query_id, CAST(place AS INTEGER) AS rank, vec_id, score FROM r WHERE place <= 5
"""
