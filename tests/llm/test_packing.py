import random
import sys
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from codeloom.llm import packing
from codeloom.llm.tables import read_table
from codeloom.llm.tokens import Encoder, default_vocabulary
from tests.llm.support import documents


@pytest.fixture(scope="module")
def encoder():
    return Encoder(open(default_vocabulary(), encoding="utf-8").read())


def checked(lengths, capacity):
    bins = packing.pack(np.array(lengths, np.int64), capacity)
    assert sorted(i for b in bins for i in b) == list(range(len(lengths)))
    assert all(sum(lengths[i] for i in b) <= capacity for b in bins)
    return len(bins)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 30), max_size=40))
def test_bins_hold_every_piece_once(lengths):
    assert checked(lengths, 30) >= -(-sum(lengths) // 30)


def exchanged(bins, lengths, capacity):
    made = packing.Exchange([list(b) for b in bins], np.array(lengths), capacity).run()
    assert sorted(i for b in made for i in b) == list(range(len(lengths)))
    assert all(sum(lengths[i] for i in b) <= capacity for b in made)
    return len(made)


def test_exchanges_empty_a_bin():
    # One for one, then a move: 3 for 2 fills the second bin, the 2 fits into the third.
    assert exchanged([[0], [1, 2], [3, 4]], [3, 7, 2, 5, 3], 10) == 2
    # Two for one: 4 + 4 for 7 fills the second bin, the 7 fits into the third.
    assert exchanged([[0, 1], [2, 3], [4]], [4, 4, 7, 2, 3], 10) == 2
    # No exchange helps: the room of the others is too small.
    assert exchanged([[0], [1, 2]], [2, 5, 4], 10) == 2
    rng = random.Random(5)
    for _ in range(20):
        lengths = [rng.randint(5, 50) for _ in range(60)]
        assert exchanged([[i] for i in range(60)], lengths, 100) <= len(packing.best_fit(np.array(lengths), 100)) + 3


def test_ids_equal_the_general_encoder(encoder):
    assert encoder.by_rank is not None
    rng = random.Random(2)
    points = [c for c in range(sys.maxunicode + 1) if not 0xD800 <= c <= 0xDFFF]
    texts = ["".join(chr(rng.choice(points)) for _ in range(50)) for _ in range(300)]
    texts += ["".join(chr(rng.choice(points[:0x500])) for _ in range(80)) for _ in range(300)]
    texts += ["  two  spaces \n\n\t tabs'll we've 'S 12345 ½ Ⅷ x y\u0085z <|endoftext|>", "a" * 5000, "ß" * 3000, "​﻿"]
    for text in texts:
        assert encoder.ids(text).tolist() == encoder.general.encode(text, add_special_tokens=False).ids, repr(text)


@pytest.mark.parametrize("start", range(0, 0x110000, 0x22000))
def test_ids_equal_for_every_code_point(encoder, start):
    for low in range(start, start + 0x22000, 0x800):
        chars = [chr(c) for c in range(low, low + 0x800) if not 0xD800 <= c <= 0xDFFF]
        text = "".join(f"a{c}1{c} {c}\n" for c in chars)
        assert encoder.ids(text).tolist() == encoder.general.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("text", [
    " " * 3_000_000, "x" + " " * 3_000_000 + "y", "\n" * 3_000_000, " \n" * 1_000_000 + "a", "\u3000" * 1_200_000, "a" * 3_000_000,
    " " * 100_000 + "a" + "\n" * 100_001, "a " * 200_000,
])
def test_ids_of_long_runs(encoder, text):
    assert encoder.ids(text).tolist() == encoder.general.encode(text, add_special_tokens=False).ids


SPECIAL_TEXTS = ["a <|endoftext|> b", "<|endoftext|>", "x  <|endoftext|><|endoftext|>\n y", "<|endoftext|", "a<|endoftext|>b" * 50, "\n\n <|endoftext|>  z"]


def test_added_tokens_are_ids_as_in_the_library():
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(default_vocabulary())
    file_text = open(default_vocabulary(), encoding="utf-8").read()
    made, as_text = Encoder(file_text), Encoder(file_text, special_as_text=True)
    altered = Tokenizer.from_file(default_vocabulary())
    altered.encode_special_tokens = True
    assert made.by_rank is not None and made.ids(SPECIAL_TEXTS[0]).tolist() == [64, 220, 50256, 275]
    for text in SPECIAL_TEXTS:
        assert made.ids(text).tolist() == plain.encode(text, add_special_tokens=False).ids, text
        assert as_text.ids(text).tolist() == altered.encode(text, add_special_tokens=False).ids, text


def test_added_tokens_of_other_kinds_and_common_beginnings():
    from tokenizers import AddedToken, Tokenizer

    texts = [*SPECIAL_TEXTS, "a<x><x>y <x>y z", "q <w> r<w>s", " <x>  <|endoftext|> <w>"]
    kinds = [
        ([AddedToken("<x>", special=True, normalized=False), AddedToken("<x>y", special=True, normalized=False)], True),
        ([AddedToken("<x>", special=True), AddedToken("<x>y", special=False)], False),
        ([AddedToken("<w>", lstrip=True, single_word=True)], False),
    ]
    for extra, ranked in kinds:
        library = Tokenizer.from_file(default_vocabulary())
        library.add_tokens(extra)
        for as_text in (False, True):
            made = Encoder(library.to_str(), as_text)
            assert (made.by_rank is not None) == ranked
            library.encode_special_tokens = as_text
            for text in texts:
                assert made.ids(text).tolist() == library.encode(text, add_special_tokens=False).ids, (text, as_text)


def test_pieces_hold_added_tokens(spark):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(default_vocabulary())
    found = packing.token_pieces(documents(spark, SPECIAL_TEXTS), with_ids=True).collect()
    assert {r.doc_id: r.ids for r in found} == {i: plain.encode(t, add_special_tokens=False).ids + [0] for i, t in enumerate(SPECIAL_TEXTS)}


def by_document(rows):
    out = {}
    for r in sorted(rows, key=lambda r: r["piece"]):
        out.setdefault(r["doc_id"], []).append(r)
    return out


def check_packed(rows, texts, encoder, capacity):
    found = by_document(rows)
    assert set(found) == set(texts)
    for doc, text in texts.items():
        ids = [*encoder.ids(text).tolist(), 0]
        own = found[doc]
        assert [r["piece"] for r in own] == list(range(len(own))) and len(own) == -(-len(ids) // capacity)
        assert [r["start"] for r in own] == [0, *np.cumsum([r["length"] for r in own])[:-1].tolist()]
        assert sum(r["length"] for r in own) == len(ids) and all(r["length"] == capacity for r in own[1:])
        for r in own:
            part = np.array(ids[r["start"]:r["start"] + r["length"]], "<u4")
            assert zlib.crc32(part.tobytes()) == r["ids_crc32"]
    sequences = {}
    for r in rows:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for placed in sequences.values():
        end = 0
        for offset, length in sorted(placed):
            assert offset == end
            end += length
        assert end <= capacity
    return len(sequences)


def test_query(spark, sf, encoder):
    texts = {r.doc_id: r.text for r in read_table(spark, sf, "documents").collect()}
    rows = [r.asDict() for r in packing.query(spark, sf).collect()]
    used = check_packed(rows, texts, encoder, packing.CAPACITY)
    assert used <= 1.01 * sum(r["length"] for r in rows) / packing.CAPACITY + 2


def test_small_shards_are_opened_again(spark, encoder):
    rng = random.Random(1)
    texts = [" ".join("word" for _ in range(rng.randint(1, 400))) for _ in range(600)] + [None, "", "x y" * 9000]
    docs = documents(spark, texts, clashing=True)
    found = packing.token_pieces(docs, with_ids=True)
    rows = [r.asDict() for r in packing.pack_pieces(found, shard_pieces=50).collect()]
    used = check_packed(rows, dict(enumerate(texts)), encoder, packing.CAPACITY)
    assert used <= -(-sum(r["length"] for r in rows) // packing.CAPACITY) + 1
    assert all(np.array(r["ids"], "<u4").tobytes() == encoder_slice(encoder, texts, r) for r in rows)


def encoder_slice(encoder, texts, r):
    ids = np.append(encoder.ids(texts[r["doc_id"]]), np.array([0], "<u4"))
    return ids[r["start"]:r["start"] + r["length"]].tobytes()


def test_empty_and_repeated_rows(spark):
    assert packing.pack_pieces(packing.token_pieces(documents(spark, []))).collect() == []
    rows = packing.pack_pieces(packing.token_pieces(documents(spark, ["a b", "a b", None], [1, 1, None]))).collect()
    assert len(rows) == 3 and sorted(r["offset"] for r in rows)[0] == 0 and len({r["sequence_id"] for r in rows}) == 1
