import random

import pytest

from codeloom.llm import toxicity
from tests.llm.support import documents

FILLER = [f"word{chr(97 + i)}{chr(97 + j)}" for i in range(20) for j in range(20)]


def corpus(spark, n, seed=1):
    """Toxic texts hold insults; half of them only words of a family that share their beginning."""
    rng = random.Random(seed)
    texts, labels = [], []
    for i in range(n):
        words = [rng.choice(FILLER) for _ in range(rng.randint(5, 80))]
        toxic = int(rng.random() < 0.25)
        if toxic:
            for _ in range(rng.randint(2, 5)):
                insult = rng.choice(["nastyword", "uglyword"]) if i % 2 else "vilek" + rng.choice("abcdefgh") + rng.choice("abcdefgh")
                words.insert(rng.randrange(len(words)), rng.choice(["", "you "]) + insult)
        texts.append(" ".join(words))
        labels.append((i, rng.randint(0, 1), toxic))
    return documents(spark, texts), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_held_out_rows_are_told_apart(spark):
    docs, labels = corpus(spark, 2500)
    scored = toxicity.score(docs, toxicity.fit(docs, labels)).select("doc_id", toxicity.held_out().alias("held"), "score", "predicted")
    truth = {r.doc_id: r.toxic for r in labels.collect()}
    rows = [r for r in scored.collect() if r.held]
    assert len(rows) > 400 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)
    assert sum(truth[r.doc_id] == r.predicted for r in rows) / len(rows) > 0.95


def test_labels_of_held_out_rows_teach_nothing(spark):
    docs, labels = corpus(spark, 800)
    lying = labels.withColumn("toxic", toxicity.F.when(toxicity.held_out(), 1 - toxicity.F.col("toxic")).otherwise(toxicity.F.col("toxic")))
    scores = [
        sorted((r.doc_id, round(r.score, 9)) for r in toxicity.score(docs, toxicity.fit(docs, given)).select("doc_id", "score").collect())
        for given in (labels, lying)
    ]
    assert scores[0] == scores[1]


def test_features_of_awkward_texts():
    lexicon = toxicity.Lexicon({"idiot": 3.0}, {"vile": 2.0})
    value = lambda text: dict(zip(toxicity.FEATURES, lexicon.features(text)))
    assert set(lexicon.features(None)) == set(lexicon.features("")) == set(lexicon.features(" \n")) == {0.0}
    assert value("you idiot")["near_second_person"] == 0.5 and value("you a b c d e f idiot")["near_second_person"] == 0
    assert value("vilest vile")["stem_hits"] == 1 and value("vile")["lexicon_hits"] == 0
    assert value("1d10t i-d-i-o-t")["disguised_hits"] == 1
    assert value("STOP it now!")["shouted_rate"] == pytest.approx(1 / 3)
    assert value("you " * 60 + "idiot " * 10)["near_second_person"] == pytest.approx(5 / 70)
    assert len(lexicon.features("x " * 500_000)) == len(toxicity.FEATURES)


def test_awkward_rows_keep_their_columns(spark):
    docs, labels = corpus(spark, 1200)
    model = toxicity.fit(docs, labels)
    odd = documents(spark, [None, "", "a b", "a b", "nastyword uglyword you nastyword"], [1, 2, 3, 3, None], clashing=True)
    found = toxicity.score(odd, model)
    assert found.count() == 5 and set(found.columns) == {*odd.columns, "predicted"}
    assert all(0 <= r.score <= 1 for r in found.collect())


def test_empty_tables_and_single_labels(spark):
    docs, labels = corpus(spark, 50)
    none, empty = labels.limit(0), documents(spark, [])
    assert {r.score for r in toxicity.score(docs, toxicity.fit(docs, none)).collect()} == {0.0}
    assert {r.score for r in toxicity.score(docs, toxicity.fit(docs, labels.filter("toxic = 1"))).collect()} == {1.0}
    assert toxicity.score(empty, toxicity.fit(empty, labels)).collect() == []


def test_stage_returns_the_columns_of_documents(spark, sf):
    from codeloom.llm.tables import read_table

    docs = read_table(spark, sf, "documents").withColumn("score", toxicity.F.lit("mine"))
    kept = toxicity.stage(spark, docs, sf)
    assert kept.columns == docs.columns and {r.score for r in kept.select("score").collect()} == {"mine"}
    assert toxicity.query(spark, sf).count() == docs.count()
