import random
import re

import pytest

from codeloom.llm import licenses
from codeloom.llm.tables import read_table
from tests.llm.support import documents, plain_rows

COLUMNS = ("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels")


def words_of(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def brute(doc_id, text):
    words = words_of(text)
    found = [
        (i, label) for phrase, label in licenses.PHRASES.items() for i in range(len(words))
        if words[i:i + len(phrase.split())] == phrase.split()
    ]
    places = [i for i, _ in found]
    return doc_id, len(words), len(found), min(places, default=None), max(places, default=None), ",".join(sorted({b for _, b in found}))


def labels(spark, text):
    return licenses.label_documents(documents(spark, [text])).first()


def test_places_of_phrases(spark):
    rng = random.Random(1)
    parts = ["cc", "by", "CC-BY", "general public license", "General Public", "license", "all", "rights", "reserved", "All rights reserved.",
             "é", "x_y", "public", "general", "ccby", "4.0", "\n"]
    texts = [" ".join(rng.choice(parts) for _ in range(rng.randint(0, 40))) for _ in range(200)]
    texts += [None, "", "...", "cc by " * 30_000, "İK Kelvin cc by", "by cc"]
    found = plain_rows(licenses.label_documents(documents(spark, texts, clashing=True)), *COLUMNS)
    assert found == sorted((brute(i, t) for i, t in enumerate(texts)), key=repr)


def test_templates_with_changes(spark):
    mit = dict(licenses.TEMPLATES)["mit"].split(" ")
    assert "mit" in labels(spark, "x y " + " ".join(mit) + " z").labels.split(",")
    changed = mit[:6] + ["put", "in"] + mit[6:14] + mit[16:]
    row = labels(spark, "Start " + " ".join(changed).upper())
    assert row.labels == "mit" and 0.75 <= row.score < 1 and row.n_base == 0 and row.base_labels == ""
    assert labels(spark, " ".join(mit[:14])).labels == ""
    rng = random.Random(2)
    shuffled = list(mit)
    rng.shuffle(shuffled)
    assert labels(spark, " ".join(shuffled)).labels == ""
    far = " ".join(mit[:13]) + " filler" * 50 + " " + " ".join(mit[13:])
    assert labels(spark, far).labels == ""


def test_method_labels_stand_beside_base_ones(spark):
    row = labels(spark, "Licensed under CC BY-NC 4.0.")
    assert row.base_labels == "cc-by" and row.labels == "cc-by,cc-by-nc" and row.score == 1.0


def test_phrases_are_read_as_texts_are(spark):
    docs = documents(spark, ["released under the mit license today", "Under The MIT-License", "under mit"])
    found = licenses.scan(docs, {"The M.I.T. License": "dotted", "The MIT License!": "mit"}, ())
    assert sorted((r.doc_id, r.label, r["first"]) for r in found.collect()) == [(0, "mit", 2), (1, "mit", 1)]
    for phrases, templates in (({"mit": "mit"}, ()), ({}, (("x", " -- "),))):
        with pytest.raises(ValueError):
            licenses.scan(docs, phrases, templates)


def test_repeated_and_missing_ids(spark):
    text = "all rights reserved"
    rows = plain_rows(licenses.label_documents(documents(spark, [text, text, "cc by", text], [1, 1, 1, None])), *COLUMNS)
    assert rows == sorted([brute(1, text), brute(1, text), brute(1, "cc by"), brute(None, text)], key=repr)


def test_empty_table(spark):
    assert licenses.label_documents(documents(spark, [])).collect() == []


def test_query(spark, sf):
    texts = {r.doc_id: r.text for r in read_table(spark, sf, "documents").collect()}
    found = licenses.query(spark, sf)
    assert plain_rows(found, *COLUMNS) == sorted((brute(i, t) for i, t in texts.items()), key=repr)
    assert all(set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1 for r in found.collect())


@pytest.mark.parametrize("word", ["Python", "Pandas", "Arrow", "Cartesian", "NestedLoop"])
def test_no_python_in_the_plan(spark, sf, word):
    assert word not in licenses.query(spark, sf)._jdf.queryExecution().executedPlan().toString()
