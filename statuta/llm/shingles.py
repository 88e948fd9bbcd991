"""Word-shingle sets of texts as 64-bit hashes, computed in numpy over Arrow string columns."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U = np.uint64
_rng = np.random.Generator(np.random.PCG64(20240607))
_BYTE = _rng.integers(0, 2**64, 256, dtype=U)
_BYTE[65:91] = _BYTE[97:123]  # A-Z as a-z
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_RADIX = int(_rng.integers(0, 2**64, dtype=U)) | 1
_PLACE = _rng.integers(0, 2**64, 64, dtype=U) | U(1)
_powers: list[np.ndarray] = []
#: Bytes hashed at a time.
WINDOW = 1 << 16


def mix(x: np.ndarray) -> np.ndarray:
    """splitmix64's finaliser."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _powers or len(_powers[0]) < n:
        size = max(n, WINDOW + 1)
        _powers[:] = [np.cumprod(np.concatenate([np.ones(1, U), np.full(size - 1, r, U)]), dtype=U) for r in (_RADIX, pow(_RADIX, -1, 2**64))]
    return _powers[0], _powers[1]


def _hash_words(raw: np.ndarray, breaks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and first bytes of the words in raw; a word also ends at each of breaks."""
    word = ~_SPACE[raw]
    cut = np.zeros(len(raw) + 1, bool)
    cut[breaks] = True
    cut[0] = cut[-1] = True
    before = np.concatenate([[False], word[:-1]])
    starts = np.flatnonzero(word & (~before | cut[:-1]))
    after = np.concatenate([word[1:], [False]])
    ends = np.flatnonzero(word & (~after | cut[1:])) + 1
    up, down = _power(len(raw) + 1)
    total = np.concatenate([np.zeros(1, U), np.cumsum(_BYTE[raw] * up[: len(raw)], dtype=U)])
    return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(U)), starts


def word_hashes(texts: pa.Array) -> Iterator[np.ndarray]:
    """For each text (null: no words) the hashes of its words, A-Z read as a-z. Memory is bounded by the window and the longest text."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    at = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, 8 * texts.offset)
    data = np.frombuffer(texts.buffers()[2], np.uint8) if at[-1] > at[0] else np.zeros(0, np.uint8)
    i = 0
    while i < len(texts):
        j = i + 1
        while j < len(texts) and at[j + 1] - at[i] <= WINDOW:
            j += 1
        if at[j] - at[i] <= WINDOW:
            hashes, starts = _hash_words(data[at[i] : at[j]], (at[i:j] - at[i]))
            edge = np.searchsorted(starts, at[i : j + 1] - at[i])
            for a, b in zip(edge[:-1], edge[1:], strict=True):
                yield hashes[a:b]
        else:
            yield _long(data[at[i] : at[j]])
        i = j


def _long(raw: np.ndarray) -> np.ndarray:
    """Word hashes of one text that is longer than a window, cut at white space."""
    out, a = [], 0
    while a < len(raw):
        b = min(len(raw), a + WINDOW)
        while b < len(raw):
            gap = np.flatnonzero(_SPACE[raw[b : b + WINDOW]])
            b += int(gap[0]) if len(gap) else min(WINDOW, len(raw) - b)
            if len(gap):
                break
        out.append(_hash_words(raw[a:b], np.zeros(0, np.int64))[0])
        a = b
    return np.concatenate(out)


def shingle_set(words: np.ndarray, k: int = 5) -> np.ndarray:
    """Sorted distinct hashes of the k-word shingles; the whole sequence as one if there are fewer words, empty without words."""
    n = len(words)
    if n == 0:
        return words
    m = min(k, n)
    total = np.full(n - m + 1, m, U)
    for j in range(m):
        total += words[j : n - m + 1 + j] * _PLACE[j]
    return np.unique(mix(total))
