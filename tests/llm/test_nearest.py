import math
import random

import pytest
from pyspark.sql import functions as F

from codeloom.llm import nearest
from tests.llm.support import duck_rows, plain_rows

SCHEMA = "vec_id long, embedding array<double>, label int, ids string, cell string, vector string, score string"
COLUMNS = ("query_id", "rank", "vec_id", "score")


def table(spark, rows):
    return spark.createDataFrame([(i, v, 0, "x", "y", "z", "s") for i, v in rows], SCHEMA)


def cosine(a, b):
    dot = aa = bb = 0.0
    for x, y in zip(a, b):
        dot, aa, bb = dot + x * y, aa + x * x, bb + y * y
    return max(-1.0, min(1.0, dot / math.sqrt(aa * bb)))


def brute(rows, k=5, step=5):
    known = {}
    for i, v in rows:
        fine = v and all(x is not None and math.isfinite(x) for x in v) and any(v)
        if i is not None and fine:
            known[i] = min(known.get(i, v), v)
    out = []
    for i, v in known.items():
        if i % step == 0:
            others = sorted((-cosine(v, w), j) for j, w in known.items() if j != i and len(w) == len(v))
            out += [(i, n + 1, j, -s) for n, (s, j) in enumerate(others[:k])]
    return sorted(out, key=repr)


def found(spark, rows, **sizes):
    return plain_rows(nearest.nearest(table(spark, rows), F.col("vec_id") % 5 == 0, **sizes), *COLUMNS)


@pytest.mark.parametrize("seed", range(2))
def test_against_all_pairs_with_small_tiles(spark, seed):
    rng = random.Random(seed)
    rows = [(i, [rng.gauss(0, 1) for _ in range(8)]) for i in range(300)]
    assert found(spark, rows, cell_rows=20, tile_bytes=64 * 30) == brute(rows)


def test_near_copies_closer_than_the_codes_can_tell(spark):
    rng = random.Random(3)
    base = [rng.gauss(0, 1) for _ in range(16)]
    rows = [(i, [x + rng.gauss(0, 1e-5) for x in base]) for i in range(400)]
    assert found(spark, rows, cell_rows=50) == brute(rows)


def test_copies_and_ties_go_to_smaller_ids(spark):
    rows = [(i, [1.0, 2.0, 3.0]) for i in range(40)] + [(40 + i, [2.0 ** (i - 5), 2.0 ** (i - 4), 3 * 2.0 ** (i - 5)]) for i in range(10)]
    rows += [(60 + i, [1.0, 0.0, -float(i)]) for i in range(8)]
    assert found(spark, rows, cell_rows=7) == brute(rows)


def test_awkward_vectors_take_no_part(spark):
    rows = [
        (0, [1.0, 0.0]), (1, None), (2, []), (3, [0.0, 0.0]), (4, [1.0, None]), (5, [float("nan"), 1.0]), (6, [float("inf"), 1.0]),
        (None, [1.0, 0.0]), (10, [2.0 ** 600, 2.0 ** 600]), (15, [2.0 ** -600, 0.0]), (20, [1.0, 2.0, 3.0]), (21, [-0.0, 1.0]), (21, [0.0, 1.0]), (25, [5.0]),
        (0, [1.0, 0.0]), (21, [3.0, 3.0]), (30, [-1.0, 0.0]), (-5, [1.0, 1.0]),
    ]
    plain = {10: [1.0, 1.0], 15: [1.0, 0.0]}
    expected = [r[:3] for r in brute([(i, plain.get(i, v)) for i, v in rows])]
    got = [r[:3] for r in found(spark, rows)]
    assert got == expected and not any(r[0] in (20, 25) for r in got)


def test_many_dimensions(spark):
    rng = random.Random(5)
    rows = [(i, [rng.gauss(0, 1) for _ in range(nearest.EXACT_DIMENSIONS + 50)]) for i in range(30)]
    assert [r[:3] for r in found(spark, rows)] == [r[:3] for r in brute(rows)]


def test_fewer_candidates_than_asked_for_and_empty_table(spark):
    assert found(spark, [(0, [1.0]), (3, [2.0])]) == [(0, 1, 3, 1.0)]
    assert found(spark, [(0, [1.0])]) == []
    assert found(spark, []) == []


def test_error_bounds_hold():
    import numpy as np

    rng = np.random.default_rng(1)
    left, right = rng.normal(size=(50, 40)) ** 5, rng.normal(size=(60, 40))
    near, off = nearest.Codes(left).products(0, 50, nearest.Codes(right))
    i, j = (x.ravel() for x in np.indices((50, 60)))
    assert (np.abs(near.ravel() - nearest.cosines(left, right, i, j)) <= off.ravel()).all()


def test_query_against_sql(spark, sf):
    got = plain_rows(nearest.query(spark, sf), *COLUMNS)
    want = duck_rows(nearest.SQL, sf, list(COLUMNS))
    assert [r[:3] for r in got] == [r[:3] for r in want] and got
    assert all(abs(a[3] - b[3]) < 1e-12 for a, b in zip(got, want))
