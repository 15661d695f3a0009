import random

import pyarrow as pa

from codeloom.llm import langid
from codeloom.llm.tables import read_table
from tests.llm.support import documents

SYLLABLES = {"aa": ["ba", "ko", "li", "mu"], "bb": ["sch", "ein", "ung", "ö"], "cc": ["que", "ais", "oux", "é"]}


def say(rng, lang, words):
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randint(1, 4))) for _ in range(words))


def corpus(spark, n=400):
    rng = random.Random(3)
    langs = [rng.choice(list(SYLLABLES)) for _ in range(n)]
    texts = [say(rng, lang, rng.randint(5, 200)) for lang in langs]
    return documents(spark, texts, langs=langs), langs


def brute_phrases(letters, training):
    count, at = 0, 0
    while at < len(letters):
        end = at + 1
        while end < len(letters) and letters[at:end + 1] in training:
            end += 1
        count, at = count + 1, end
    return count


def test_automaton_accepts_exactly_the_substrings():
    rng = random.Random(1)
    for _ in range(30):
        text = "".join(rng.choice("ab ") for _ in range(rng.randint(0, 30)))
        steps, _ = langid.suffix_automaton(text)
        for _ in range(60):
            word = "".join(rng.choice("ab ") for _ in range(rng.randint(1, 6)))
            state = 0
            for letter in word:
                state = steps[state].get(letter) if state is not None else None
            assert (state is not None) == (word in text)


def trained(training):
    import numpy as np

    rows = []
    for lang, text in training.items():
        steps, _ = langid.suffix_automaton(text)
        flat = [(s, c, t) for s, row in enumerate(steps) for c, t in row.items()]
        rows.append({"lang": lang, "size": len(text), "states": len(steps), "letters": "".join(c for _, c, _ in flat),
                     "steps": np.array([(s, t) for s, _, t in flat], np.int32).tobytes()})
    return langid.combine(rows)


def test_phrases_against_plain_parsing():
    rng = random.Random(7)
    training = {lang: say(rng, lang, 150) for lang in SYLLABLES}
    languages = trained(training)
    texts = [say(rng, rng.choice(list(SYLLABLES)), n) for n in (1, 2, 20, 90, 400)] + ["X1é!!Ö", "жж кк", "", "a", "12 34"]
    blocks, first, letters = langid.blocks_of(pa.array(texts), languages)
    for name, table in zip(languages.names, languages.tables):
        counts = langid.phrases(blocks, table, languages.width)
        for i, text in enumerate(texts):
            clean = langid.letters_of(text) + " " * bool(text and not text[-1].isalpha() and any(map(str.isalpha, text)))
            cut = [clean[k:k + langid.BLOCK] for k in range(0, len(clean), langid.BLOCK)]
            assert counts[first[i]:first[i + 1]].tolist() == [brute_phrases(c, training[name]) for c in cut]
            assert letters[i] == sum(c.isalpha() for c in text)


def test_held_out_accuracy(spark):
    docs, langs = corpus(spark)
    found = langid.identify(docs, langid.learn(docs)).select("doc_id", langid.held_out().alias("held"), "lang_pred", "score").collect()
    held = [r for r in found if r.held]
    assert len(held) > 40 and sum(langs[r.doc_id] == r.lang_pred for r in held) / len(held) > 0.97
    assert all(0 <= r.score <= 1 for r in found)


def test_awkward_rows(spark):
    docs, _ = corpus(spark, 120)
    languages = langid.learn(docs)
    odd = documents(spark, [None, "", "123 !?", "ba" * 100_000, "ein schung", "ein schung"], [1, 2, 3, 4, None, 4], clashing=True)
    rows = langid.identify(odd, languages).collect()
    by_text = {r.text: r for r in rows}
    assert len(rows) == 6 and set(odd.columns) < set(rows[0].asDict())
    assert [by_text[t].lang_pred for t in (None, "", "123 !?")] == ["und"] * 3 and by_text["ein schung"].lang_pred == "bb"
    assert by_text["ba" * 100_000].lang_pred == "aa" and by_text[None].score == 0


def test_nothing_to_learn_from(spark):
    empty = documents(spark, [])
    languages = langid.learn(empty)
    assert langid.identify(empty, languages).collect() == []
    assert {r.lang_pred for r in langid.identify(documents(spark, ["a", None]), languages).collect()} == {"und"}
    only = documents(spark, ["some words here"] * 30, langs=["xx"] * 30)
    assert {(r.lang_pred, r.score) for r in langid.identify(only, langid.learn(only)).collect()} == {("xx", 1.0)}


def test_query(spark, sf):
    truth = {r.doc_id: r.lang for r in read_table(spark, sf, "documents").collect()}
    rows = langid.query(spark, sf).collect()
    held = [r for r in rows if r.held_out and truth[r.doc_id]]
    assert len(rows) == len(truth) and sum(truth[r.doc_id] == r.lang_pred for r in held) / len(held) > 0.9
