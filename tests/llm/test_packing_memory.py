"""Token ids by slices of texts: equal to whole texts, little kept from slice to slice, each word encoded once a slice."""

from __future__ import annotations

import random
import tracemalloc

import pyarrow as pa
import pytest

from rollmart.llm import packing

PARTS = [" ", " ", "\n", "a", "b", "C", "é", "ß", "中", "ا", "9", "12", "'s", "'", ".", ",", "(", "<|endoftext|>", "\t", "\x1c",
         " ", "​", "́", "\U0001f600", "word", "don't", "\r\n", "_", "²", "ª"]


@pytest.fixture(scope="module")
def encoder():
    return packing.Encoder(packing.default_tokenizer())


def in_slices(encoder, texts):
    rows = pa.array(texts, pa.string())
    return [ids for at, n in packing._slices(rows) for ids in encoder.batch(rows.slice(at, n))]


@pytest.mark.parametrize("slice_bytes, gathered, at_once, remembered", [(8_000_000, 200_000, 20_000, 150_000), (2_000, 50, 7, 20), (1, 1, 1, 0)])
def test_slices_encode_like_whole_texts(encoder, monkeypatch, slice_bytes, gathered, at_once, remembered):
    for name, value in (("SLICE", slice_bytes), ("GATHERED", gathered), ("WORDS_AT_ONCE", at_once), ("REMEMBERED", remembered)):
        monkeypatch.setattr(packing, name, value)
    rng = random.Random(7)
    texts = ["", "\n", " ", *("".join(rng.choice(PARTS) for _ in range(rng.randrange(16))) for _ in range(1500)), "a b " * 500 + "c"]
    assert in_slices(encoder, texts) == encoder._encode(texts)


def test_slices_hold_all_rows_in_order(monkeypatch):
    monkeypatch.setattr(packing, "SLICE", 10)
    texts = pa.array(["", "a" * 4, "b" * 6, "c", "d" * 50, "", "e" * 9, "é" * 5])
    assert list(packing._slices(texts)) == [(0, 3), (3, 1), (4, 1), (5, 2), (7, 1)]
    assert list(packing._slices(texts.slice(0, 0))) == []


def test_words_that_occur_once_are_not_kept():
    rng = random.Random(11)
    texts = [" ".join("".join(rng.choices("abcdefghij", k=9)) for _ in range(2_000)) for _ in range(50)]
    own = packing.Encoder(packing.default_tokenizer())
    tracemalloc.start()
    try:
        for text in texts:
            own.ids(text)
        kept = tracemalloc.get_traced_memory()[0]
    finally:
        tracemalloc.stop()
    assert kept < 2_000_000


def test_each_word_is_encoded_once_a_slice_and_repeated_ones_once(encoder):
    class Counted:
        def __init__(self, model):
            self.model, self.asked = model, []

        def tokenize(self, text):
            self.asked.append(text)
            return self.model.tokenize(text)

    own = packing.Encoder(packing.default_tokenizer())
    own.model = counted = Counted(own.model)
    texts = ["start often rare", "start often seldom", "start often rare", "start often"]
    assert in_slices(own, texts) == encoder._encode(texts)
    assert sorted(counted.asked) == sorted(["start"] * 4 + ["Ġoften", "Ġrare", "Ġseldom"])
    counted.asked.clear()
    assert in_slices(own, ["other often rare"]) == encoder._encode(["other often rare"])
    assert sorted(counted.asked) == ["other", "Ġrare"]
