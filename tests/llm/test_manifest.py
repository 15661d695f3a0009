import random
import zlib
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from codeloom.llm import manifest
from tests.llm.support import CLASHING, DOCS, duck_rows, plain_rows

COLUMNS = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def leaf(row, text):
    doc_id, _, lang, source, n_chars = row
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)))


def proof_and_root(digests, at):
    """Sibling runs upwards as (left, right), and the root."""
    path = []
    while len(digests) > 1:
        run = at // 3 * 3
        path.append(("".join(digests[run:at]), "".join(digests[at + 1:run + 3])))
        digests = [h(*digests[i:i + 3]) for i in range(0, len(digests), 3)]
        at //= 3
    return path, digests[0]


def brute(rows):
    first = lambda v: (v is not None, v if v is not None else 0)
    sources = sorted({r[3] for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: sorted((r for r in rows if r[3] == s), key=lambda r: (first(r[0]), leaf(r, r[1]))) for s in sources}
    leaves = {s: [leaf(r, r[1]) for r in tree] for s, tree in trees.items()}
    subroots = [proof_and_root(leaves[s], 0)[1] for s in sources]
    out = []
    for n, s in enumerate(sources):
        upper, root = proof_and_root(subroots, n)
        for at, r in enumerate(trees[s]):
            path = proof_and_root(leaves[s], at)[0] + upper
            chosen = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0
            folded = leaf(r, r[1].replace("\n", "") if chosen and r[1] is not None else r[1])
            for left, right in path:
                folded = h(left, folded, right)
            proof = h(*(x for pair in path for x in pair))
            out.append((r[0], leaves[s][at], subroots[n], root, proof, folded, folded == root))
    return sorted(out, key=repr)


def proofs(spark, rows, levels=manifest.LEVELS, schema=DOCS):
    docs = spark.createDataFrame(rows, schema)
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    now = F.when(chosen, F.replace(F.col("text"), F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    return manifest.Manifest(docs, manifest.leaf(now), levels)


def random_rows(seed, n=300):
    rng = random.Random(seed)
    texts = ["a\nb", "", None, "é\n", "x" * 50_000 + "\n", "plain"]
    sources = ["hot"] * 20 + ["b", "é", "z", "", None, "B", *(f"s{i}" for i in range(8))]
    return [(rng.choice([i, i, i, 7, None]), rng.choice(texts), rng.choice(["en", None]), rng.choice(sources), rng.choice([1, None, -5])) for i in range(n)]


@pytest.mark.parametrize("levels", [1, 2, 6])
def test_against_plain_trees(spark, levels):
    rows = random_rows(levels)
    clashing = [(*r, None, "x", "y", "z", "l", "p", 1, 2) for r in rows]
    assert plain_rows(proofs(spark, clashing, levels, CLASHING).proofs(), *COLUMNS) == brute(rows)


@pytest.mark.parametrize("n", [1, 3, 4])
def test_small_trees(spark, n):
    rows = [(i, f"t{i}\n", "en", "s", 2) for i in range(n)]
    got = plain_rows(proofs(spark, rows).proofs(), *COLUMNS)
    assert got == brute(rows)
    if n == 1:
        assert got[0][1] == got[0][2] == got[0][3] and got[0][4] == h("")


def test_repeated_rows_and_empty_table(spark):
    rows = [(1, "same\n", "en", "s", 5)] * 40
    assert plain_rows(proofs(spark, rows, 2).proofs(), *COLUMNS) == brute(rows)
    assert proofs(spark, []).proofs().collect() == []


def test_every_node_is_listed_with_its_interval(spark):
    rows = [(i, "t", "en", "s" if i < 50 else "t", i) for i in range(60)]
    nodes = {(r.source, r.level, r.lo): r for r in proofs(spark, rows, 2).nodes().collect()}
    for source, n in (("s", 50), ("t", 10)):
        digests, level = [leaf(r, "t") for r in rows if r[3] == source], 0
        while True:
            for i, d in enumerate(digests):
                node = nodes.pop((source, level, i * 3 ** level))
                assert node.digest == d and node.hi == min((i + 1) * 3 ** level, n) - 1
            if len(digests) == 1:
                break
            digests, level = [h(*digests[i:i + 3]) for i in range(0, len(digests), 3)], level + 1
    assert not nodes


def test_query_against_sql(spark, sf):
    got = plain_rows(manifest.query(spark, sf), *COLUMNS)
    assert got == duck_rows(manifest.SQL, sf, list(COLUMNS))
    assert {r[-1] for r in got} == {True, False}
