"""Operator 10: quality classifier from weak labels.

Overlapping heuristic labellers vote good, bad or nothing on every document. Expectation-maximisation over the counts of all vote
patterns estimates how often each labeller is right and which share of documents is good, and gives each pattern a posterior. On a
bounded sample the posteriors train a linear scorer over hashed character-class four-grams and repetition measures, and the scorer
judges every document from its whole text. Given labels are not used; tests hold the result against them.

Two passes read the texts: one for votes (and the sample's features), one for scores. The driver gets the number of documents of each
vote pattern, at most 3 ** 8, and the sample's features as index and value pairs, a few hundred for a document.

Characters are classed by byte: A-Z are capitals, a-z and everything outside ASCII count as small letters.

Edge cases: a null or empty text, or one of white space only, has score 0.0 and is rejected; rows that repeat a doc_id each get a row,
rows without one too, and the sample goes by rows; an empty table gives an empty result; other columns, whatever their names,
are ignored by classify() and kept by keep_good().
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, LongType, StructField, StructType

from .shared import Scratch, importable
from .shingles import word_hashes

#: Documents that the scorer is trained on, about.
SAMPLE = 8192
BUCKETS = 2048
#: Documents whose probability of being good is lower are rejected.
CUT = 0.5
#: Prior share of good documents, and the prior's weight as a share of all documents.
BALANCE, CERTAINTY = 0.7, 0.1
#: Bytes of a text that are read at a time.
WINDOW = 1 << 16

LABELLERS = ("capitals", "symbols", "columns", "shouting", "variety", "stutter", "letters", "prose")

_UPPER, _LOWER, _SYMBOL, _SHOUT = (np.zeros(256, bool) for _ in range(4))
_UPPER[65:91] = _LOWER[97:123] = _LOWER[128:] = True
_SYMBOL[list(b"#$%&*|!<>{}=~^\\")] = True
_SHOUT[list(b"!?*#$%&")] = True

_CLASS = np.full(256, 11, np.int64)  # control characters
_CLASS[0x20] = 0
_CLASS[[0x09, 0x0A, 0x0D]] = 1
_CLASS[65:91], _CLASS[97:123], _CLASS[48:58], _CLASS[128:] = 2, 3, 4, 3
for _i, _chars in enumerate((b".,;:'\"()-", b"!?", b"#$%&*", b"|", b"<>{}[]\\/", b"=~^_`@+"), 5):
    _CLASS[list(_chars)] = _i
_GRAM = ((np.arange(12**4, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)).astype(np.int64) % BUCKETS
EXTRA = 12
WIDTH = BUCKETS + EXTRA + 1


def _windows(raw: np.ndarray) -> Iterator[np.ndarray]:
    """raw in pieces of WINDOW bytes, each with the byte before it and the two or three after it (spaces at the ends)."""
    for at in range(0, len(raw), WINDOW):
        end = min(len(raw), at + WINDOW)
        before = raw[at - 1 : at] if at else np.array([0x20], np.uint8)
        yield np.concatenate([before, raw[at : end + 3], np.full(max(0, 3 - (len(raw) - end)), 0x20, np.uint8)])


def measure(raw: np.ndarray) -> dict[str, float]:
    """Counts over the bytes of one text: characters, capitals, small letters, symbols, ' | ', runs of shouting marks, ends of sentences."""
    seen, columns, shouts, stops = np.zeros(256, np.int64), 0, 0, 0
    for x in _windows(raw):
        here = x[1:-3]
        counts = np.bincount(here, minlength=256)
        seen += counts
        if counts[0x7C]:
            columns += int(((here == 0x7C) & (x[:-4] == 0x20) & (x[2:-2] == 0x20)).sum())
        if counts[_SHOUT].any():
            loud = _SHOUT[x]
            shouts += int((loud[1:-3] & loud[2:-2] & ~loud[:-4]).sum())
        at = np.flatnonzero(here == 0x2E) + 1
        after, later = x[at + 1], x[at + 2]
        stops += int((_LOWER[x[at - 1]] & ((after == 0x0A) | ((after == 0x20) & (_UPPER[later] | (later >= 0xC0))))).sum())
    stops += int(len(raw) > 1 and raw[-1] == 0x2E and _LOWER[raw[-2]])
    return {
        "chars": int(seen.sum() - seen[128:192].sum()), "upper": int(seen[_UPPER].sum()), "lower": int(seen[97:123].sum() + seen[192:].sum()),
        "symbols": int(seen[_SYMBOL].sum()), "columns": columns, "shouts": shouts, "stops": stops,
    }


def votes(raw: np.ndarray, words: np.ndarray) -> list[int]:
    """What each of LABELLERS says of a text, given its bytes and word hashes: 1 good, -1 bad, 0 no vote."""
    m, n = measure(raw), max(1, len(words))
    letters, variety = (m["lower"] + m["upper"]) / max(1, m["chars"]), len(np.unique(words)) / min(n, 400)
    symbols, stops = m["symbols"] / n, m["stops"] / n
    prose = 1 if letters >= 0.72 and stops >= 0.02 and variety >= 0.3 and symbols <= 0.05 else -1 if stops <= 0.0005 and n >= 50 else 0
    bad = (
        m["upper"] >= 0.3 * max(1, m["upper"] + m["lower"]), symbols >= 0.25, m["columns"] >= 0.2 * n, m["shouts"] >= 0.2 * n,
        variety <= 0.2, (words[1:] == words[:-1]).sum() >= 0.15 * n, letters <= 0.7,
    )
    return [*(-int(b) for b in bad), prose]


def expectation_maximisation(patterns: np.ndarray, weights: np.ndarray, rounds: int = 500) -> tuple[np.ndarray, np.ndarray, float]:
    """patterns: votes in {-1, 0, 1}, one row each; weights: how many documents have them.

    Returns the posterior of each pattern, each labeller's accuracy (how often its votes are right; 0 is no vote and says nothing)
    and the share of good documents. Labellers are taken as independent given the class, and start as mostly right. The share has a
    beta prior (BALANCE, CERTAINTY), because labellers that mostly vote on bad documents say little about it.
    """
    total = max(1.0, float(weights.sum()))
    accuracy, balance, share = np.full(patterns.shape[1], 0.85), BALANCE, np.zeros(len(patterns))
    for _ in range(rounds):
        odds = np.log(balance / (1 - balance)) + patterns @ np.log(accuracy / (1 - accuracy))
        new = 1 / (1 + np.exp(-np.clip(odds, -60, 60)))
        right = weights @ ((patterns == 1) * new[:, None] + (patterns == -1) * (1 - new)[:, None])
        accuracy = np.clip((right + 8.5) / (weights @ (patterns != 0) + 10), 0.5, 0.999)
        balance = float(np.clip((weights @ new / total + CERTAINTY * BALANCE) / (1 + CERTAINTY), 0.01, 0.99))
        done, share = np.abs(new - share).max() < 1e-9, new
        if done:
            break
    return share, accuracy, balance


def _texts(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(bytes, word hashes) of each text; a null is empty."""
    texts = pc.fill_null(column, "").cast(pa.large_string())
    at = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, 8 * texts.offset)
    data = np.frombuffer(texts.buffers()[2], np.uint8) if at[-1] > at[0] else np.zeros(0, np.uint8)
    for a, b, words in zip(at[:-1], at[1:], word_hashes(texts), strict=True):
        yield data[a:b], words


def features(raw: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indices and values of a text's features: square roots of shares of hashed four-grams, one-hot word variety and repetition, 1."""
    grams = np.zeros(BUCKETS, np.int64)
    for i in range(0, len(raw), WINDOW):
        c = _CLASS[raw[i : min(len(raw), i + WINDOW + 3)]]
        if len(c) > 3:
            grams += np.bincount(_GRAM[((c[:-3] * 12 + c[1:-2]) * 12 + c[2:-1]) * 12 + c[3:]], minlength=BUCKETS)
    at = np.flatnonzero(grams)
    value = np.sqrt(grams[at] / max(1, grams.sum()))
    n, more = len(words), [WIDTH - 1]
    if n:
        more += [BUCKETS + min(5, int(6 * len(np.unique(words)) / min(n, 400))), BUCKETS + 6 + min(5, int(12 * (words[1:] == words[:-1]).sum() / n))]
    return np.concatenate([at, more]), np.concatenate([value, np.ones(len(more))])


def train(index: np.ndarray, value: np.ndarray, size: np.ndarray, goal: np.ndarray, epochs: int = 30, batch: int = 256, penalty: float = 1e-4) -> np.ndarray:
    """Weights of a logistic regression on soft labels, by Adam on small batches with a falling step; rows are runs of `size` pairs of index and value."""
    rng, start = np.random.default_rng(0), np.cumsum(size) - size
    w, m, v, t = np.zeros(WIDTH), np.zeros(WIDTH), np.zeros(WIDTH), 0
    for epoch in range(epochs):
        order = rng.permutation(len(size))
        for at in range(0, len(order), batch):
            rows = order[at : at + batch]
            long = size[rows]
            edge = np.cumsum(long) - long
            pick = np.arange(long.sum()) + np.repeat(start[rows] - edge, long)
            i, x = index[pick], value[pick]
            error = 1 / (1 + np.exp(-np.clip(np.add.reduceat(x * w[i], edge), -60, 60))) - goal[rows]
            g = np.bincount(i, weights=x * np.repeat(error, long), minlength=WIDTH) / len(rows) + penalty * w
            t += 1
            m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
            w -= 0.1 * (1 - epoch / epochs) * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-9)
    return w


def _code(said: list[int]) -> int:
    return sum((v + 1) * 3**k for k, v in enumerate(said))


def _votes_of(code: int) -> list[int]:
    return [code // 3**k % 3 - 1 for k in range(len(LABELLERS))]


def fit(docs: DataFrame, sample: int = SAMPLE) -> np.ndarray:
    """Weights of the scorer for docs (doc_id, text): votes of all documents, features of about `sample` of them."""
    importable(docs.sparkSession)
    share = min(1.0, sample / max(1, docs.count()))
    chosen = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(1 << 30)) < int(share * (1 << 30))

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            code, index, value = [], [], []
            for wanted, (raw, words) in zip(batch.column(1).to_pylist(), _texts(batch.column(0)), strict=True):
                if len(words):
                    i, x = features(raw, words) if wanted else (None, None)
                    code.append(_code(votes(raw, words)))
                    index.append(i.astype("<u2").tobytes() if wanted else None)
                    value.append(x.astype("<f4").tobytes() if wanted else None)
            yield pa.RecordBatch.from_arrays([pa.array(code, pa.int32()), pa.array(index, pa.binary()), pa.array(value, pa.binary())], ["code", "i", "x"])

    scratch = Scratch(docs.sparkSession)
    seen = scratch.write(docs.select("text", chosen.alias("chosen")).mapInArrow(look, "code int, i binary, x binary"))
    counts = seen.groupBy("code").agg(F.count("*").alias("n")).collect()  # at most 3 ** 8 patterns
    # at most twice the sample, a few kB a document; in a fixed order, so that a rerun trains on the same rows
    rows = sorted(tuple(r) for r in seen.where("i is not null").orderBy(F.xxhash64("i", "x"), "code").limit(2 * sample).collect())
    scratch.drop(seen)
    if not rows:
        return np.zeros(WIDTH)
    codes = sorted(r["code"] for r in counts)
    of = {r["code"]: float(r["n"]) for r in counts}
    good, _, _ = expectation_maximisation(np.array([_votes_of(c) for c in codes]), np.array([of[c] for c in codes]))
    posterior = dict(zip(codes, good.tolist(), strict=True))
    index, value = (np.concatenate([np.frombuffer(r[k], t) for r in rows]) for k, t in ((1, "<u2"), (2, "<f4")))
    return train(index.astype(np.int32), value, np.array([len(r[1]) // 2 for r in rows]), np.array([posterior[r[0]] for r in rows]))


def _scores(column: pa.Array, weights: np.ndarray) -> Iterator[tuple[int, float]]:
    """(number of words, probability of being good, rounded) of each text."""
    for raw, words in _texts(column):
        if len(words):
            i, x = features(raw, words)
            yield len(words), round(float(1 / (1 + np.exp(-np.clip(x @ weights[i], -60, 60)))), 6)
        else:
            yield 0, 0.0


def classify(docs: DataFrame, cut: float = CUT, sample: int = SAMPLE) -> DataFrame:
    """One row per document: doc_id, n_words, score (probability of being good), kept."""
    docs = docs.select("doc_id", "text")
    weights = fit(docs, sample)
    schema = StructType([docs.schema["doc_id"], StructField("n_words", LongType()), StructField("score", DoubleType()), StructField("kept", BooleanType())])

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = list(_scores(batch.column(1), weights))
            n, score, kept = [n for n, _ in got], [s for _, s in got], [s >= cut and n > 0 for n, s in got]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(score, pa.float64()), pa.array(kept, pa.bool_())], schema.names)

    return docs.mapInArrow(judge, schema)


def keep_good(docs: DataFrame, cut: float = CUT, sample: int = SAMPLE) -> DataFrame:
    """docs without the rejected documents; a single pass after fitting, which sends each row to a worker once and the kept ones back."""
    weights = fit(docs.select("doc_id", "text"), sample)
    names, text = docs.columns, docs.columns.index("text")

    def sift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = batch.filter(pa.array([s >= cut and n > 0 for n, s in _scores(batch.column(text), weights)], pa.bool_()))
            yield kept.rename_columns(names)

    # plain names, as mapInArrow resolves columns by name and cannot take one with a dot
    return docs.toDF(*[f"c{i}" for i in range(len(docs.columns))]).mapInArrow(sift, docs.schema)
