import hashlib
import random
import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from codeloom.llm import exact
from codeloom.llm.quotient import QuotientFilter
from tests.llm.support import documents, duck_rows, plain_rows

COLUMNS = ("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def brute(texts, ids):
    normal = [re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for t in texts]
    out = []
    for text, i in zip(normal, ids):
        same = [j for u, j in zip(normal, ids) if u == text]
        known = [j for j in same if j is not None]
        keep = min(known) if known else i
        out.append((i, keep, len(same), i == keep, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=repr)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2 ** 20 - 1), max_size=60), max_size=6))
def test_filters_merge_without_loss(parts):
    bits = 20
    filters = [QuotientFilter.from_bytes(QuotientFilter.of_prints(np.array(p, np.uint64), bits).to_bytes()) for p in parts]
    prints, counts = QuotientFilter.merged(filters, bits).counts()
    flat = [x for p in parts for x in p]
    assert dict(zip(prints.tolist(), counts.tolist())) == {x: flat.count(x) for x in flat}
    assert prints.tolist() == sorted(set(flat))


def test_filter_keeps_large_counts_and_whole_64_bit_prints():
    prints = np.array([0, 5, 2 ** 63, 2 ** 64 - 1], np.uint64)
    counts = np.array([1, 2 ** 40, 2 ** 32, 2 ** 32 + 1])
    back = QuotientFilter.from_bytes(QuotientFilter.of_counts(prints, counts, 64).to_bytes()).counts()
    assert back[0].tolist() == prints.tolist() and back[1].tolist() == counts.tolist()


def test_against_plain_grouping(spark):
    rng = random.Random(1)
    texts = [rng.choice(["a b", "a  b", "a\tb", " a b", "a b ", "A b", "", None, " ", "\n\n", "é", "x" * 200_000]) for _ in range(200)]
    ids = list(range(200))
    rng.shuffle(ids)
    assert plain_rows(exact.exact_duplicates(documents(spark, texts, ids, clashing=True)), *COLUMNS) == brute(texts, ids)


def test_many_slices_give_the_same(spark):
    texts = [f"t{i % 70}" for i in range(300)]
    docs = documents(spark, texts).repartition(7)
    assert plain_rows(exact.exact_duplicates(docs, slice_rows=10), *COLUMNS) == brute(texts, list(range(300)))


def test_missing_and_repeated_ids(spark):
    texts, ids = ["a", "a", "a", "b", "b", "c"], [3, 3, None, None, None, 9]
    assert plain_rows(exact.exact_duplicates(documents(spark, texts, ids)), *COLUMNS) == brute(texts, ids)


def test_empty_table(spark):
    assert exact.exact_duplicates(documents(spark, [])).collect() == []


def test_query_against_sql(spark, sf):
    assert plain_rows(exact.query(spark, sf), *COLUMNS) == duck_rows(exact.SQL, sf, list(COLUMNS))


def test_stage_keeps_first_of_equal_texts(spark):
    kept = exact.stage(spark, documents(spark, ["a b", "a  b", "c", None, ""], clashing=True), "")
    assert sorted(r.doc_id for r in kept.collect()) == [0, 2, 3]
    assert kept.columns == documents(spark, [], clashing=True).columns
