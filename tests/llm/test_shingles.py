"""Word hashes: the same whatever the window, the batch and the slice."""

import random

import numpy as np
import pyarrow as pa
import pytest

from statuta.llm import quality, shingles


def _texts():
    rng = random.Random(0)
    word = lambda: "".join(rng.choice("abcXYZéß\U0001f600,.") for _ in range(rng.randint(1, 9)))
    return [None, "", "  ", "a", *[" \t\n\x0b\x0c\r"[i % 6].join(word() for _ in range(rng.randint(1, 60))) for i in range(80)], "x" * 500, " ".join(word() for _ in range(900))]


@pytest.mark.parametrize("window", [7, 64, 1000])
def test_windows(monkeypatch, window):
    texts = _texts()
    whole = list(shingles.word_hashes(pa.array(texts)))
    monkeypatch.setattr(shingles, "WINDOW", window)
    small = list(shingles.word_hashes(pa.array(["skip", *texts])[1:]))
    assert [len(w) for w in whole] == [len((t or "").encode().split()) for t in texts]
    assert all(np.array_equal(a, b) for a, b in zip(whole, small, strict=True))


def test_equal_words_have_equal_hashes():
    a, b = shingles.word_hashes(pa.array(["The END é the", "x the end É"]))
    assert a[0] == a[3] == b[1] and a[1] == b[2] and a[2] != b[3]


def test_short_texts_are_one_shingle():
    one, four, five = (shingles.shingle_set(w) for w in shingles.word_hashes(pa.array(["a", "a b c d", "a b c d e"])))
    assert len(one) == len(four) == len(five) == 1 and len({one[0], four[0], five[0]}) == 3


def test_features_do_not_depend_on_the_window(monkeypatch):
    texts = pa.array(_texts())
    dense = lambda: [np.bincount(i, weights=x, minlength=quality.WIDTH) for raw, words in quality._texts(texts) for i, x in [quality.features(raw, words)]]
    whole = np.stack(dense())
    monkeypatch.setattr(quality, "WINDOW", 50)
    assert np.allclose(whole, np.stack(list(dense())))
