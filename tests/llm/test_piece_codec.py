"""Encoding and decoding against the library that defines them."""

import hashlib
import random

import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from plaza.llm import piece_codec, queries

PIECES = queries.PIECES


@pytest.fixture(scope="module")
def model():
    return piece_codec.load_model(PIECES)


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PIECES)


def same(model, library, texts):
    got = [x.tolist() for x in model.encode(texts)]
    assert got == library.encode(texts, num_threads=1)
    assert [model.decode(x) for x in got] == [library.decode(x) for x in got]


def test_query_equals_the_library(spark, small, table, library):
    got = {r.doc_id: tuple(r)[1:] for r in queries.op13_piece_codec(spark, small).collect()}
    docs = table(small, "documents")
    assert len(got) == len(docs)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for d in docs:
        ids = library.encode(d["text"] or "")
        assert got[d["doc_id"]] == (len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids)))


ODD = ["", " ", "   ", "  a", "a  ", "a\n\n\tb", "▁a ▁", "\x00a", "<s>x</s><0x0A>", "日本語𝕏", "﻿a", "à é", "  ▁", "ngngng singing", " " * 100 + "x", "x" + " " * 15 + "y", "\r\n});\r\n", "😀😀 😀"]


def test_odd_texts(model, library):
    same(model, library, ODD)


#: Alphabets whose words tie, overlap, and make pairs that precede what is left of the round.
@pytest.mark.parametrize("letters", ["abc ", "nging ", "aA ", "the ing", "\r\n);}\"' ", "αβγа б", "01 ", " ", "etaoinshrdlu", "日本語 的"])
def test_random_words_of_few_letters(model, library, letters):
    r = random.Random(letters)
    same(model, library, ["".join(r.choices(letters, k=r.randint(1, 200))) for _ in range(300)])


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(), max_size=5))
def test_any_text(model, library, texts):
    same(model, library, texts)


def test_long_texts_without_spaces(model, library):
    r = random.Random(3)
    same(model, library, ["".join(r.choices("abcdefghijklmnopqrstuvwxyz", k=100_000)), "ng" * 50_000, " " * 50_000, "the" * 30_000])


def test_memory_and_parts_change_nothing(monkeypatch, model, library):
    monkeypatch.setattr(piece_codec, "MAX_WORDS", 3)
    monkeypatch.setattr(piece_codec, "PART_CHARS", 7)
    for texts in (["one two three four five six", "two seven"], ["seven one", ""]):
        same(model, library, texts)


def test_ids_that_no_text_gives(model, library):
    """Broken characters, control pieces and unknown ones anywhere."""
    byte = lambda b: 3 + b
    for ids in ([byte(0xE6), byte(0x97)], [byte(0xFF), 264, byte(0xC3), byte(0xA9)], [1, 264, 2], [0], [0, 264, 264], [28705, 28705], [byte(0xE6), 264, byte(0xA5)]):
        assert model.decode(ids) == library.decode(ids)


def test_odd_rows(spark, odd, empty, model, library):
    clash = odd.withColumnRenamed("score", "piece_ids")
    rows = piece_codec.decode(piece_codec.encode(clash, model), model)
    assert rows.columns == ["doc_id", "text", "lang", "source", "n_chars", "n_words", "piece_ids", "piece_text"]
    got = sorted((repr(r.doc_id), repr(r.text), r.piece_ids, r.piece_text) for r in rows.collect())
    want = [(x, library.encode(x.text or "")) for x in clash.collect()]
    assert got == sorted((repr(x.doc_id), repr(x.text), ids, library.decode(ids)) for x, ids in want)
    assert piece_codec.decode(piece_codec.encode(empty, model), model).count() == 0


def test_other_models_are_refused():
    with pytest.raises(ValueError, match="mark after"):
        piece_codec.PieceModel([("a", 0.0, 1), ("▁", 0.0, 1), ("a▁", -1.0, 1)])
