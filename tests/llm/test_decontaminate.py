import random
import re

import pytest

from codeloom.llm import decontaminate
from tests.llm.support import documents, duck_rows, plain_rows

COLUMNS = ("doc_id", "item_id", "n_shared", "n_item", "containment")


def words(text):
    return re.findall(r"[^\W_]+", (text or "").lower())


def runs(found, n):
    return {tuple(found[i:i + n]) for i in range(len(found) - n + 1)}


def brute(texts, items, ids=None):
    out = []
    for i, text in enumerate(texts):
        for j, item in items:
            own = words(item)
            n = min(5, len(own))
            own, there = runs(own, n) if n else set(), runs(words(text), n)
            if own and 100 * len(own & there) >= 75 * len(own):
                out.append(((ids or range(len(texts)))[i], j, len(own & there), len(own), len(own & there) / len(own)))
    return sorted(out, key=repr)


def run(spark, texts, items, clashing=True):
    docs = documents(spark, texts, clashing=clashing)
    return plain_rows(decontaminate.contaminated(docs, spark.createDataFrame(items, "item_id long, text string")), *COLUMNS)


def test_items_inside_long_documents(spark):
    rng = random.Random(2)
    vocabulary = [f"w{i}" for i in range(300)]
    some = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    items = [(i, " ".join(some(rng.choice([2, 4, 5, 7, 12, 30, 120])))) for i in range(40)]
    texts = [" ".join(some(rng.choice([0, 3, 50, 3000]))) for _ in range(40)]
    for _ in range(120):
        item = rng.choice(items)[1].split(" ")
        cut = item[:max(1, int(len(item) * rng.choice([0.5, 0.75, 0.8, 0.9, 1])))]
        if rng.random() < 0.3:
            cut[rng.randrange(len(cut))] = "changed"
        texts.append(" ".join(some(rng.choice([0, 40, 2000])) + cut + some(rng.choice([0, 40]))))
    texts += [None, "", "...", items[0][1].upper().replace(" ", ", "), "long " * 40_000]
    found = run(spark, texts, items)
    assert found == brute(texts, items) and len(found) > 25


def test_short_items_as_consecutive_words(spark):
    items = [(1, "capital of france"), (2, "Oslo"), (3, "one two three four"), (4, "\u4f60\u597d\u4e16\u754c"), (5, "!"), (6, None)]
    texts = [
        "tell me what is the capital of France, is it", "capital city of france", "oslo", "all roads lead to Oslo now or then",
        "zero one two three four five", "one two three", "\u6211\u8bf4\u3002\u4f60\u597d\u4e16\u754c\u3002", "!", None,
    ]
    found = run(spark, texts, items)
    assert found == brute(texts, items)
    assert [(d, i) for d, i, *_ in found] == [(0, 1), (2, 2), (3, 2), (4, 3), (6, 4)]


def test_votes_miss_less_than_asked():
    rng = random.Random(1)
    for hashes in (8, 12, 16, 24):
        votes = decontaminate.votes_needed(hashes, 75, 0.01)
        missed = sum(sum(rng.random() < 0.75 for _ in range(hashes)) < votes for _ in range(4000))
        assert missed / 4000 < 0.02 and votes > 1


@pytest.mark.parametrize("texts, items", [([], [(1, "a b c d e f")]), (["a b c d e f"], []), ([], [])])
def test_empty_tables(spark, texts, items):
    assert run(spark, texts, items) == []


def test_nulls_repeats_and_ties(spark):
    text = "a b c d e f g h"
    docs = documents(spark, [text, text, text, None], [1, 1, None, 2])
    items = spark.createDataFrame([(7, text), (7, text), (8, text), (None, text), (9, None)], "item_id long, text string")
    found = plain_rows(decontaminate.contaminated(docs, items), *COLUMNS)
    assert found == [(1, 7, 4, 4, 1.0), (1, 8, 4, 4, 1.0)]


def test_without_a_broadcast(spark, sf, monkeypatch):
    monkeypatch.setattr("codeloom.llm.tables.BROADCAST_ROWS", -1)
    assert plain_rows(decontaminate.query(spark, sf), *COLUMNS) == duck_rows(decontaminate.SQL, sf, list(COLUMNS))


def test_query_against_sql(spark, sf):
    found = plain_rows(decontaminate.query(spark, sf), *COLUMNS)
    assert found == duck_rows(decontaminate.SQL, sf, list(COLUMNS))


def test_no_python_in_the_plan(spark, sf):
    plan = decontaminate.query(spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow", "CartesianProduct", "BroadcastNestedLoop"))
