from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from sensorflow.llm.bpe import Lexicon, bpe_round_trip, build_lexicon, compiled, decoded, frequent_words, token_digests, vocabulary

from .conftest import AWKWARD, prose

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)
WORDS = vocabulary(PATH)


def ids_of(text):
    out = []
    for part in WORDS.parts(text):
        out += [WORDS.added[part]] if part in WORDS.added else WORDS.merged(part)
    return out


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.characters(exclude_categories=["Cs"]), st.sampled_from(" \n\t'stlve19aé<|>")), max_size=40))
def test_ids_equal_the_library(text):
    assert ids_of(text) == LIBRARY.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("text", ["a" * 20_000, " " * 3000 + "x", "ab" * 5000, "x<|endoftext|> y<|endoftext|>", "it's we'll 'tis", "՘a₀"])
def test_long_and_odd_texts_equal_the_library(text):
    assert ids_of(text) == LIBRARY.encode(text, add_special_tokens=False).ids


def test_short_and_long_words_merge_alike():
    rng = random.Random(4)
    for _ in range(500):
        word = bytes(rng.choice(b"abcdeinorst ") for _ in range(rng.randint(1, 40)))
        ids = [WORDS.of_byte[byte] for byte in word]
        assert WORDS._merged_short(list(ids)) == WORDS._merged_long(list(ids))


def test_lexicon_is_exact_and_minimal():
    words = {w.encode(): [i, 7 * i] for i, w in enumerate(["tap", "taps", "top", "tops", "stop", "stops", "", "é"])}
    lexicon = Lexicon(compiled(words))
    for word, ids in words.items():
        assert np.frombuffer(lexicon.find(word), "<u4").tolist() == ids
    for missing in (b"t", b"ta", b"tapss", b"x", b"\xc3"):
        assert lexicon.find(missing) is None
    # states with the same continuations are one: count the distinct sets of continuations
    rest = {frozenset(w[len(p) :] for w in words if w.startswith(p)) for word in words for p in (word[:k] for k in range(len(word) + 1))}
    assert len(lexicon.ends) == len(rest)
    assert Lexicon(compiled({})).find(b"a") is None
    assert Lexicon(build_lexicon(["the", " the"], PATH)).find(b" the") is not None


def test_round_trip(spark, rng):
    rows = [(i, prose(rng, rng.randint(0, 300)) + rng.choice(["", "中文 ok", " <|endoftext|>", "  x"])) for i in range(80)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    for most in (0, 50, 100_000):  # no lexicon, a small one, all words
        found = {r.doc_id: r for r in bpe_round_trip(frame, PATH, most_words=most).collect()}
        for i, text in rows:
            ids = LIBRARY.encode(text, add_special_tokens=False).ids
            assert np.frombuffer(found[i].ids, "<u4").tolist() == ids and found[i].n_tokens == len(ids)
            assert found[i].decoded == LIBRARY.decode(ids, skip_special_tokens=False) == text


def test_frequent_words_are_those_above_a_count(spark):
    frame = spark.createDataFrame([("a a a b b c",), ("a b d",), (None,)], "text string")
    assert set(frequent_words(frame, PATH, most=4)) == {"a", " a", " b"}  # the next count has too many words
    assert frequent_words(frame, PATH, most=0) == []
    assert len(frequent_words(frame, PATH, most=100)) == 5


def test_bytes_that_are_no_text_decode_like_the_library():
    ids = [WORDS.of_byte[b] for b in (0xC3, 0x28, 0xE2, 0x82, 0x41, 0xFF)]
    assert decoded(np.array(ids, "<u4").tobytes(), WORDS) == LIBRARY.decode(ids, skip_special_tokens=False)


def test_awkward_rows(spark, awkward):
    found = token_digests(bpe_round_trip(awkward, PATH)).collect()
    assert len(found) == len(AWKWARD)
    empty = hashlib.sha256(b"").hexdigest()
    assert sum(r.n_tokens == 0 and r.ids_sha256 == empty == r.decoded_sha256 for r in found) == 4
    assert bpe_round_trip(awkward.limit(0), PATH).count() == 0
