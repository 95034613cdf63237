from __future__ import annotations

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from sentencepiece import SentencePieceProcessor

from sensorflow.llm.bpe import token_digests
from sensorflow.llm.pieces import SPACE, model, piece_round_trip, text_ids

from .conftest import AWKWARD, prose

PATH = public_tokenizers.path("piece_bpe_32k.model")
LIBRARY = SentencePieceProcessor(model_file=PATH)
MODEL = model(PATH)


def ids_of(text):
    return np.frombuffer(text_ids(text, PATH), "<u4").tolist()


def decoded(ids):
    return MODEL.decoded(np.array(ids, "<u4").tobytes())


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet=st.one_of(st.characters(exclude_categories=["Cs"]), st.sampled_from(" \n\tthenaio19é▁<|>0x中的\x00")), max_size=40))
def test_ids_and_text_equal_the_library(text):
    ids = LIBRARY.encode(text, add_bos=True, add_eos=True)
    assert [1, *ids_of(text), 2] == ids
    assert decoded(ids) == LIBRARY.decode(ids)


@pytest.mark.parametrize(
    "text", ["a" * 20_000, " " * 5000, "  x" * 3000, "ab" * 5000, "的一" * 3000, "=" * 9999, "<s> </s> <unk> <0x41>", "\x00", " ", "x ", "\U0001f9ff" * 50, "the" * 4000]
)
def test_long_and_odd_texts_equal_the_library(text):
    assert ids_of(text) == LIBRARY.encode(text)


def test_backtracking_equals_merging_the_whole_text():
    rng = random.Random(5)
    backtracked = 0
    for _ in range(3000):
        text = SPACE + "".join(rng.choices("aeinorst" + SPACE, k=rng.randint(0, 24)))
        found = MODEL.pieces(text)
        assert found == MODEL.merged(text)
        greedy, at = [], 0
        while at < len(text):
            greedy.append(max((text[at:end] for end in range(at + 1, len(text) + 1) if text[at:end] in MODEL.ids), key=len))
            at += len(greedy[-1])
        backtracked += found != greedy
    assert backtracked > 100  # the longest piece is often not the right one


def test_texts_without_word_borders_are_encoded_whole(monkeypatch, rng):
    monkeypatch.setattr(MODEL, "by_words", False)
    for _ in range(50):
        text = prose(rng, 30) + rng.choice(["", "  x ", "中文"])
        assert ids_of(text) == LIBRARY.encode(text)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 31_999), st.integers(3, 258), st.sampled_from([0, 1, 2, 259, 28705])), max_size=10))
def test_any_ids_decode_like_the_library(ids):
    assert decoded(ids) == LIBRARY.decode(ids)


def test_other_kinds_of_models_are_refused(monkeypatch):
    monkeypatch.setattr("sensorflow.llm.pieces.SentencePieceProcessor.is_unused", lambda self, i: i == 300)
    with pytest.raises(ValueError, match="unused"):
        type(MODEL)(PATH)


def test_round_trip(spark, rng):
    rows = [(i, prose(rng, rng.randint(0, 300)) + rng.choice(["", "中文 ok", "  two", "▁", "\r\n"])) for i in range(80)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = {r.doc_id: r for r in piece_round_trip(frame, PATH).collect()}
    for i, text in rows:
        ids = LIBRARY.encode(text, add_bos=True, add_eos=True)
        assert np.frombuffer(found[i].ids, "<u4").tolist() == ids and found[i].n_tokens == len(ids)
        assert found[i].decoded == LIBRARY.decode(ids)


def test_awkward_rows(spark, awkward):
    found = token_digests(piece_round_trip(awkward, PATH)).collect()
    assert len(found) == len(AWKWARD)
    ends = hashlib.sha256(np.array([1, 2], "<u4").tobytes()).hexdigest()
    assert sum(r.n_tokens == 2 and r.ids_sha256 == ends for r in found) == 4
    assert piece_round_trip(awkward.limit(0), PATH).count() == 0
    kept = piece_round_trip(awkward, PATH, keep=("source", "ids")).select("columns.source", "columns.ids")
    assert sorted(str(r.source) for r in kept.collect()) == sorted(str(row[2]) for row in AWKWARD)
