import random

import numpy as np
import pyarrow as pa
import pytest

from codeloom.llm import minhash
from codeloom.llm.components import components
from codeloom.llm.shingles import shingle_sets
from codeloom.llm.tables import Store, read_table
from tests.llm.support import documents, duck_rows, plain_rows


def words_of(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for space in "\t\n\x0b\x0c\r":
        lowered = lowered.replace(space, " ")
    return [w for w in lowered.split(" ") if w]


def shingles(text, k=5):
    words = words_of(text)
    if not words:
        return frozenset()
    if len(words) < k:
        return frozenset([tuple(words)])
    return frozenset(tuple(words[i:i + k]) for i in range(len(words) - k + 1))


def brute(texts, percent=75):
    sets = [shingles(t) for t in texts]
    label = list(range(len(texts)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if common and 100 * common >= percent * len(sets[i] | sets[j]):
                a, b = root(i), root(j)
                label[max(a, b)] = min(a, b)
    return sorted(((i, len(sets[i]), root(i), root(i) == i) for i in range(len(texts))), key=repr)


COLUMNS = ("doc_id", "n_shingles", "component_id", "kept")


def test_sets_hold_each_shingle_once():
    texts = ["a b c d e f", "A B\tc\nd e f", "a b c", None, "  \n ", "a b c d e a b c d e a b c d e", "é É ß x y z"]
    values, starts = shingle_sets(pa.array(texts, pa.string()), 5)
    assert np.diff(starts).tolist() == [len(shingles(t)) for t in texts]
    assert set(values[starts[0]:starts[1]]) == set(values[starts[1]:starts[2]])


def test_every_coordinate_is_filled_and_agreement_is_near_the_similarity():
    rng = np.random.default_rng(1)
    pool = rng.integers(0, 2 ** 63, 4000).astype(np.uint64)
    sets = [pool[:1], pool[:7], pool[:3000], pool[1000:4000]]
    starts = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
    made = minhash.sketches(np.concatenate(sets), starts, 1000)
    assert (made != np.iinfo(np.uint64).max).all()
    assert abs((made[2] == made[3]).mean() - 0.5) < 0.06
    assert abs((made[0] == made[1]).mean() - 1 / 7) < 0.05


def test_groups_against_all_pairs(spark):
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(400)]
    texts = []
    for _ in range(25):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([3, 6, 20, 60, 150]))]
        for _ in range(rng.randint(1, 6)):
            copy = list(base)
            for _ in range(rng.randint(0, 1 + len(base) // 30)):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            texts.append(" ".join(copy))
    texts += [None, "", " \n\t", "one", "ONE", "one two three", "one  two\tthree", "x " * 30_000, "x " * 30_000 + "y"]
    assert plain_rows(minhash.near_duplicates(documents(spark, texts, clashing=True)), *COLUMNS) == brute(texts)


def test_chain_of_drifting_copies_and_a_hub_are_one_group_each(spark):
    rng = random.Random(4)
    words = [f"c{i}" for i in range(160)]
    chain = []
    for _ in range(40):
        chain.append(" ".join(words))
        words[rng.randrange(160)] = f"n{rng.random()}"
    hub = [f"h{i}" for i in range(200)]
    copies = [" ".join(hub[:i] + [f"x{i}"] + hub[i + 1:]) for i in range(200)]
    texts = chain + copies
    assert plain_rows(minhash.near_duplicates(documents(spark, texts)), *COLUMNS) == brute(texts)


def test_repeated_and_missing_ids(spark):
    long = "a b c d e f g h i j"
    found = plain_rows(minhash.near_duplicates(documents(spark, [long, long, long, "q r", None], [5, 5, None, 7, None])), *COLUMNS)
    assert found == sorted([(5, 6, 5, True), (5, 6, 5, True), (None, 6, 5, False), (7, 1, 7, True), (None, 0, None, True)], key=repr)


def test_empty_table(spark):
    assert minhash.near_duplicates(documents(spark, [])).collect() == []
    assert minhash.stage(spark, documents(spark, []), "").columns == documents(spark, []).columns


@pytest.mark.parametrize("links", [[], [(3, 3)], [(i, i + 1) for i in range(100)], [(0, i) for i in range(1, 50)] + [(60, 61)]])
def test_components(spark, links):
    frame = spark.createDataFrame(links, "a long, b long")
    found = dict(tuple(r) for r in components(frame, Store(spark, "test")).collect())
    nodes = {x for a, b in links if a != b for x in (a, b)}
    assert set(found) == nodes
    assert all(found[a] == found[b] for a, b in links if a != b)
    assert all(found[n] == (60 if n >= 60 and len(links) == 50 else 0) for n in nodes)


def test_query_against_sql(spark, sf):
    assert plain_rows(minhash.query(spark, sf), *COLUMNS) == duck_rows(minhash.SQL, sf, list(COLUMNS))


def test_stage_keeps_one_of_each_group(spark, sf):
    docs = read_table(spark, sf, "documents")
    kept = {r.doc_id for r in minhash.stage(spark, docs, sf).collect()}
    assert kept == {r.doc_id for r in minhash.near_duplicates(docs).filter("kept").collect()}
