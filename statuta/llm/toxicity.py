"""Operator 12: toxicity by a linear classifier over character n-grams scaled by naive Bayes log-count ratios.

A text's features are the hashed character n-grams of three to five characters that it holds anywhere (A-Z and other capitals read as small
letters, runs of white space and ASCII punctuation as one space, no space inside an n-gram). Over all labelled rows of the training fold the
rows that hold a feature are counted for each class; the logarithm of the ratio of its shares in the two classes is the feature's value
wherever it is present. Logistic regression on the FEATURES most telling ones then gives weights, trained on a bounded sample of about SAMPLE
labelled rows, half of each class where there are as many. Margins become probabilities by a curve fitted on margins of rows that the fold's
model had not seen. Every document is scored from its whole text, in pieces of WINDOW characters that overlap.

What reaches the driver: FEATURES counts and the sample's rows over these features. Counts are added in tasks first, then by feature. Labels
meet texts by a merge join at every size, so the texts of the fold are shuffled once.

Edge cases: a null or empty text has no feature and gets the score of the intercept; a null doc_id has no label and is not held out; a doc_id
whose labels contradict each other is not trained on, nor are null labels and labels without a document; of rows that repeat a doc_id each is
a training row and gets a score; without training rows of both classes every score is 0.0; an empty table gives an empty result; other columns
are ignored. The score never sees doc_id, lang, source or labels.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, IntegerType, StructField, StructType

from .shared import Scratch, importable

SHORTEST, LONGEST = 3, 5
BUCKETS = 1 << 20
#: Features that the linear classifier weighs, at most.
FEATURES = 1 << 14
#: Rows that the classifier is trained on, about; counts cover all labelled rows of the fold.
SAMPLE = 8192
#: Documents of this score are called toxic.
CUT = 0.7
#: Characters of a text that are read at a time.
WINDOW = 1 << 16

U = np.uint64
_ODD = [U(int(x) | 1) for x in np.random.Generator(np.random.PCG64(12)).integers(0, 2**64, LONGEST, dtype=U)]
_BLANK = np.ones(128, bool)
_BLANK[48:58] = _BLANK[97:123] = False


def _characters(text: str) -> np.ndarray:
    """Code points in small letters, with one space for each run of white space and punctuation, and at both ends."""
    c = np.frombuffer(f" {text} ".lower().encode("utf-32-le", "surrogatepass"), "<u4")
    space = c < 128
    space[space] = _BLANK[c[space]]
    c = np.where(space, np.uint32(32), c)
    return c[~(space & np.concatenate([[False], space[:-1]]))]


def grams(text: str | None) -> Iterator[np.ndarray]:
    """Buckets of the n-grams of a text, repeats included, in pieces of bounded size."""
    for at in range(0, len(text or ""), WINDOW):
        c = _characters(text[max(0, at - LONGEST) : at + WINDOW])
        total, inside = c.astype(U) * _ODD[0], np.ones(len(c), bool)
        for n in range(1, LONGEST):
            if len(c) <= n:
                break
            total = total[:-1] + c[n:] * _ODD[n]
            if n > 1:  # the character before the last is inside
                inside = inside[:-1] & (c[n - 1 : -1] != 32)
            else:
                inside = inside[:-1]
            if n + 1 >= SHORTEST:
                h = total[inside]
                yield ((h ^ (h >> U(29))) * _ODD[0] >> U(44)).astype(np.int64)


def _texts(column: pa.Array) -> Iterator[str | None]:
    return (t.as_py() for t in column)


def labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(toxic, text, u): rows of the training fold, u being a hash of the row."""
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 != 1
    known = labels.where(F.col("toxic").isin(0, 1) & fold).groupBy(F.col("doc_id").alias("of")).agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("most"))
    rows = docs.select("doc_id", "text", F.xxhash64(F.monotonically_increasing_id()).alias("u"))
    # labels grow with the documents, so they are not broadcast at any size
    return rows.join(known.where("toxic = most").hint("merge"), F.col("doc_id") == F.col("of")).select("toxic", "text", "u")


def _seen(rows: DataFrame, shares: list[float]) -> DataFrame:
    """(bucket, toxic_rows, clean_rows) summed by task, and (toxic, held), the sorted buckets of each row that is in the sample."""
    chosen = F.pmod("u", F.lit(1 << 30)) < F.when(F.col("toxic") == 1, int(shares[1] * (1 << 30))).otherwise(int(shares[0] * (1 << 30)))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, flag = np.zeros((2, BUCKETS), np.int64), np.zeros(BUCKETS, bool)
        none = lambda n: pa.nulls(n, pa.int64())
        for batch in batches:
            kept: list[tuple[int, bytes]] = []
            for toxic, text, wanted in zip(batch.column(0).to_pylist(), _texts(batch.column(1)), batch.column(2).to_pylist(), strict=True):
                for buckets in grams(text):
                    flag[buckets] = True
                held = np.flatnonzero(flag)
                flag[held] = False
                total[toxic][held] += 1
                if wanted:
                    kept.append((toxic, held.astype("<u4").tobytes()))
            if kept:
                yield pa.RecordBatch.from_arrays([none(len(kept))] * 3 + [pa.array([t for t, _ in kept], pa.int32()), pa.array([h for _, h in kept], pa.binary())], names)
        at = np.flatnonzero(total.any(axis=0))
        for i in range(0, len(at), 1 << 16):
            part = at[i : i + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(total[1][part]), pa.array(total[0][part]), pa.nulls(len(part), pa.int32()), pa.nulls(len(part), pa.binary())], names)

    names = ["bucket", "toxic_rows", "clean_rows", "toxic", "held"]
    return rows.select("toxic", "text", chosen.alias("chosen")).mapInArrow(count, "bucket long, toxic_rows long, clean_rows long, toxic int, held binary")


def log_ratios(toxic: np.ndarray, clean: np.ndarray, n_toxic: int, n_clean: int) -> np.ndarray:
    """Naive Bayes: log of the smoothed share of toxic rows that hold a feature over that of clean rows."""
    return np.log((toxic + 1.0) / (n_toxic + 2.0)) - np.log((clean + 1.0) / (n_clean + 2.0))


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -60, 60)))


def train(index: np.ndarray, size: np.ndarray, goal: np.ndarray, value: np.ndarray, steps: int = 2000, batch: int = 128, penalty: float = 1e-3) -> tuple[np.ndarray, float]:
    """Weights and intercept of a logistic regression whose rows are runs of `size` present features, by Adam with a falling step."""
    rng, start = np.random.default_rng(0), np.cumsum(size) - size
    width = len(value) + 1  # the last one is the intercept
    w, m, v, t = np.zeros(width), np.zeros(width), np.zeros(width), 0
    while t < steps:
        order = rng.permutation(len(size))
        for at in range(0, len(order), batch):
            rows = order[at : at + batch]
            long, row = size[rows], np.arange(len(rows))
            i = index[np.arange(long.sum()) + np.repeat(start[rows] - (np.cumsum(long) - long), long)]
            row = np.repeat(row, long)
            error = _sigmoid(np.bincount(row, weights=value[i] * w[i], minlength=len(rows)) + w[-1]) - goal[rows]
            g = np.bincount(i, weights=value[i] * error[row], minlength=width) / len(rows) + penalty * w
            g[-1] = error.mean()
            t += 1
            m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
            w -= 0.02 * max(0.0, 1 - t / steps) * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-9)
    return w[:-1] * value, float(w[-1])


def margins(index: np.ndarray, size: np.ndarray, weights: np.ndarray, intercept: float) -> np.ndarray:
    return np.bincount(np.repeat(np.arange(len(size)), size), weights=weights[index], minlength=len(size)) + intercept


def calibrate(margin: np.ndarray, goal: np.ndarray, rounds: int = 100) -> tuple[float, float]:
    """Slope and offset that turn margins into probabilities, each class counting alike and its goals drawn in by its size."""
    n1, n0 = goal.sum(), (1 - goal).sum()
    soft = np.where(goal == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    weight = np.where(goal == 1, 0.5 / n1, 0.5 / n0)
    x = np.stack([margin, np.ones(len(margin))])
    at = np.array([1.0, 0.0])
    for _ in range(rounds):
        p = _sigmoid(at @ x)
        step = np.linalg.solve((x * (weight * p * (1 - p))) @ x.T + 1e-9 * np.eye(2), x @ (weight * (p - soft)))
        at = at - np.clip(step, -1, 1)
        if np.abs(step).max() < 1e-9:
            break
    return float(max(at[0], 1e-6)), float(at[1])


class Model:
    """weight of each bucket, intercept, slope and offset; None where there was nothing to learn."""

    def __init__(self, weight: np.ndarray, intercept: float, slope: float, offset: float):
        self.weight, self.intercept, self.slope, self.offset = weight, intercept, slope, offset

    def score(self, text: str | None) -> float:
        hit = [b[self.weight[b] != 0] for b in grams(text)]
        margin = self.intercept + (float(self.weight[np.unique(np.concatenate(hit))].sum()) if hit else 0.0)
        return round(float(_sigmoid(np.float64(self.slope * margin + self.offset))), 9)


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, features: int = FEATURES, folds: int = 3) -> Model | None:
    """The classifier learnt from labels (doc_id, toxic) on docs (doc_id, text)."""
    importable(docs.sparkSession)
    rows = labelled(docs, labels)
    n = [0, 0]
    for r in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect():
        n[r["toxic"]] = r["n"]
    if not min(n):
        return None
    scratch = Scratch(docs.sparkSession)
    seen = scratch.write(_seen(rows, [min(1.0, sample / 2 / k) for k in n]))
    counts = seen.where("bucket is not null").groupBy("bucket").agg(F.sum("toxic_rows").alias("t"), F.sum("clean_rows").alias("c"))
    # how much more often than by chance a class holds the feature
    expected = (F.col("t") + F.col("c")) * (n[1] / (n[0] + n[1]))
    telling = F.abs(F.col("t") - expected) / F.sqrt(expected + 1)
    best = counts.where("t + c > 1").orderBy(telling.desc(), "bucket").limit(features).toPandas().sort_values("bucket")
    buckets = best["bucket"].to_numpy()
    value = log_ratios(best["t"].to_numpy(), best["c"].to_numpy(), n[1], n[0])
    number = np.full(BUCKETS, -1, np.int32)
    number[buckets] = np.arange(len(buckets))

    def narrow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = [number[np.frombuffer(h, "<u4")] for h in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([h[h >= 0].astype("<u2").tobytes() for h in held], pa.binary())], ["toxic", "held"])

    drawn = seen.where("held is not null").select("toxic", "held").mapInArrow(narrow, "toxic int, held binary")
    drawn = sorted((r["toxic"], bytes(r["held"])) for r in drawn.collect())  # about `sample` rows of at most `features` numbers
    scratch.drop(seen)
    goal, size = np.array([t for t, _ in drawn], float), np.array([len(h) // 2 for _, h in drawn])
    index = np.frombuffer(b"".join(h for _, h in drawn), "<u2").astype(np.int64)
    if len(np.unique(goal)) < 2:
        return None
    fold = np.random.default_rng(1).permutation(len(goal)) % folds
    unseen = np.zeros(len(goal))
    of = np.repeat(fold, size)
    for k in range(folds):
        model = train(index[of != k], size[fold != k], goal[fold != k], value)
        unseen[fold == k] = margins(index[of == k], size[fold == k], *model)
    weights, intercept = train(index, size, goal, value)
    weight = np.zeros(BUCKETS)
    weight[buckets] = weights
    return Model(weight, intercept, *calibrate(unseen, goal))


def score(docs: DataFrame, labels: DataFrame, cut: float = CUT, **options) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    docs = docs.select("doc_id", "text")
    model = fit(docs, labels, **options)
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))
    schema = StructType([docs.schema["doc_id"], StructField("held_out", BooleanType()), StructField("score", DoubleType()), StructField("predicted", IntegerType())])

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [model.score(t) if model else 0.0 for t in _texts(batch.column(2))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(got, pa.float64()), pa.array([int(s >= cut) for s in got], pa.int32())], schema.names)

    return docs.select("doc_id", held_out.alias("held_out"), F.col("text")).mapInArrow(judge, schema)
