"""Operator 13: embedding whitening from a streamed covariance.

Vectors become integers floor(256 * c). The fit list, each distinct integer vector once, is read by partition iterators that keep number, exact
sums, mean and centred second moments, and change them by Welford's rank-one update for each vector. Partition states are merged by the parallel
update formula, MERGED at a time, in levels. A symmetric QR iteration of our own (Householder reduction to tridiagonal form, then shifted
rotations) solves the last state's covariance for its eigenvalues and vectors. The whitened fit list runs through the same update once more and
its distance from the identity is measured, not assumed.

Vectors of different lengths span different spaces, so each length is fitted on its own list. The models, one row for each length, are joined with
the rows: Spark broadcasts them under its size limit, else rows and models meet by length and one of SALTS salts. No task holds more than MERGED
states of one length; nothing but two numbers reaches the driver.

Edge cases: rows whose vector is null or holds null or non-finite entries are dropped; an empty vector has no component and no row; a null vec_id
stays null; rows that repeat a vec_id or a vector each get their rows. Where an eigenvalue is zero (one distinct vector, a constant entry) whitened
is null, and identity_error covers the other components, 0.0 if there are none; explained is 0.0 where the variance is zero. Vectors of fewer
entries than components have as many components as entries. A deviation is null where a long cannot hold it, a sum
of the list or n times an entry. Entries whose 256-fold no long can hold
become the nearest long. An empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import Scratch, importable

SCALE = 256
COMPONENTS = 4
#: States of partitions that are merged in one task.
MERGED = 32
SALTS = 64

STATE = "key long, n long, total array<decimal(38,0)>, mean binary, moment binary"


class State:
    """Number, exact sums, mean and centred second moments (sum of outer products) of the vectors seen."""

    def __init__(self, d: int):
        self.n, self.total, self.mean, self.moment = 0, [0] * d, np.zeros(d), np.zeros((d, d))

    def add(self, x: np.ndarray) -> None:
        """Welford's update by one vector: a matrix of rank one."""
        self.n += 1
        before = x - self.mean
        self.mean += before / self.n
        self.moment += np.multiply.outer(before, x - self.mean)

    def merge(self, other: State) -> None:
        """The parallel update: two states become that of both lists."""
        n = self.n + other.n
        if not n:
            return
        apart = other.mean - self.mean
        self.moment += other.moment + np.multiply.outer(apart, apart) * (self.n * other.n / n)
        self.mean += apart * (other.n / n)
        self.total = [a + b for a, b in zip(self.total, other.total, strict=True)]
        self.n = n

    def row(self) -> tuple:
        return self.n, self.total, self.mean.tobytes(), self.moment.tobytes()

    @classmethod
    def of(cls, n: int, total, mean: bytes, moment: bytes) -> State:
        out = cls(len(total))
        out.n, out.total, out.mean = int(n), [int(t) for t in total], np.frombuffer(mean).copy()
        out.moment = np.frombuffer(moment).reshape(len(total), len(total)).copy()
        return out


def _sums(x: np.ndarray) -> list[int]:
    """Column sums without overflow: high and low halves are added apart."""
    return [(int(h) << 32) + int(low) for h, low in zip((x >> 32).sum(axis=0), (x & 0xFFFFFFFF).sum(axis=0), strict=True)]


def _states(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One state for each key among a partition's vectors; vectors of one key have one length."""
    open_: dict[int, State] = {}
    for batch in batches:
        keys, column = batch.column(0).to_numpy(), batch.column(1)
        at, flat = column.offsets.to_numpy() - column.offsets[0].as_py(), column.flatten().to_numpy()
        for key in np.unique(keys):
            rows = np.flatnonzero(keys == key)
            d = int(at[rows[0] + 1] - at[rows[0]])
            x = flat[at[rows][:, None] + np.arange(d)]
            state = open_.setdefault(int(key), State(d))
            if x.dtype.kind == "i":
                state.total = [a + b for a, b in zip(state.total, _sums(x), strict=True)]
            for v in x.astype(np.float64):
                state.add(v)
    if open_:
        columns = zip(*[(key, *s.row()) for key, s in open_.items()], strict=True)
        types = [pa.int64(), pa.int64(), pa.list_(pa.decimal128(38, 0)), pa.binary(), pa.binary()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["key", "n", "total", "mean", "moment"])


def _read(group: pd.DataFrame) -> State:
    """The states of one key, merged in the order of their partitions."""
    rows = group.sort_values("part")
    first, *others = (State.of(*r) for r in zip(rows["n"], rows["total"], rows["mean"], rows["moment"], strict=True))
    for other in others:
        first.merge(other)
    return first


def _merge(group: pd.DataFrame) -> pd.DataFrame:
    n, total, mean, moment = _read(group).row()
    return pd.DataFrame({"key": [group["key"].iloc[0]], "part": [group["part"].min() // MERGED], "n": [n], "total": [[Decimal(t) for t in total]], "mean": [mean], "moment": [moment]})


def covariance_states(vectors: DataFrame, scratch: Scratch) -> DataFrame:
    """vectors: (key, v), v an array of numbers without nulls, of one length for a key. At most MERGED states of each key, with their part."""
    states = scratch.write(vectors.mapInArrow(_states, STATE).withColumn("part", F.spark_partition_id().cast("long")))
    most = states.agg(F.max("part")).first()[0] or 0
    while most >= MERGED:
        states = scratch.write(states.groupBy("key", F.floor(F.col("part") / MERGED).alias("level")).applyInPandas(_merge, STATE + ", part long"))
        most //= MERGED
    return states


def tridiagonal(a: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Householder reflections: diagonal, off-diagonal and the orthogonal q with a = q t q'."""
    a, n = a.copy(), len(a)
    q = np.eye(n)
    for k in range(n - 2):
        x = a[k + 1 :, k].copy()
        size = np.linalg.norm(x)
        if size == 0.0 or size == abs(x[0]):
            continue
        x[0] += np.copysign(size, x[0])
        x /= np.linalg.norm(x)
        p = a[k + 1 :, k + 1 :] @ x
        p -= (x @ p) * x
        a[k + 1 :, k + 1 :] -= 2 * (np.multiply.outer(x, p) + np.multiply.outer(p, x))
        a[k, k + 1 :] -= 2 * (a[k, k + 1 :] @ x) * x
        a[k + 1 :, k] = a[k, k + 1 :]
        q[:, k + 1 :] -= 2 * np.multiply.outer(q[:, k + 1 :] @ x, x)
    return np.diag(a).copy(), np.diag(a, 1).copy(), q


def symmetric_qr(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors in the columns: implicit QR steps with Wilkinson's shift on the tridiagonal form."""
    n = len(a)
    d, e, q = tridiagonal(np.asarray(a, float))
    q = q.T.copy()  # eigenvectors in rows, so that a rotation works on whole rows
    end = n - 1
    while end > 0:
        small = np.abs(e) <= np.finfo(float).eps * (np.abs(d[:-1]) + np.abs(d[1:]))
        e[small] = 0.0
        while end > 0 and e[end - 1] == 0.0:
            end -= 1
        if end == 0:
            break
        top = end - 1
        while top > 0 and e[top - 1] != 0.0:
            top -= 1
        half = (d[end - 1] - d[end]) / 2
        far = np.hypot(half, e[end - 1])
        shift = d[end] - e[end - 1] ** 2 / (half + np.copysign(far, half)) if far else d[end]
        x, z = d[top] - shift, e[top]
        for k in range(top, end):
            r = np.hypot(x, z)
            c, s = (x / r, z / r) if r else (1.0, 0.0)
            if k > top:
                e[k - 1] = r
            dk, dn, ek = d[k], d[k + 1], e[k]
            d[k] = c * c * dk + 2 * c * s * ek + s * s * dn
            d[k + 1] = s * s * dk - 2 * c * s * ek + c * c * dn
            e[k] = c * s * (dn - dk) + (c * c - s * s) * ek
            if k < end - 1:
                x, z = e[k], s * e[k + 1]
                e[k + 1] *= c
            upper = c * q[k] + s * q[k + 1]
            q[k + 1] = c * q[k + 1] - s * q[k]
            q[k] = upper
    order = np.argsort(-d, kind="stable")
    return d[order], q[order].T


MODEL = "key long, n long, total array<long>, centre array<double>, whiten array<array<double>>, explained array<double>"


def _solve(group: pd.DataFrame) -> pd.DataFrame:
    """Components of one length: rows that whiten (empty where the eigenvalue is zero) and the shares of the variance."""
    state = _read(group)
    v = state.moment / state.n
    v = (v + v.T) / 2
    values, vectors = symmetric_qr(v)
    trace = float(np.trace(v))
    k = min(COMPONENTS, len(v))
    alive = values > len(v) * np.finfo(float).eps * max(trace, 0.0)
    whiten = [(vectors[:, i] / np.sqrt(values[i])).tolist() if alive[i] else [] for i in range(k)]
    explained = [float(values[i]) / trace if trace > 0 else 0.0 for i in range(k)]
    centre = [t / state.n for t in state.total]
    total = state.total if max(map(abs, state.total)) < 2**63 else []
    return pd.DataFrame({"key": [group["key"].iloc[0]], "n": [state.n], "total": [total], "centre": [centre], "whiten": [whiten], "explained": [explained]})


def _distance(group: pd.DataFrame) -> pd.DataFrame:
    state = _read(group)
    error = float(np.abs(state.moment / state.n - np.eye(len(state.mean))).max()) if len(state.mean) else 0.0
    return pd.DataFrame({"of": [group["key"].iloc[0]], "identity_error": [error]})


def _deviation(xs: pa.Array, totals: pa.Array, ns: pa.Array) -> pa.Array:
    """Sum of (n x - S)^2 in longs, which is exact where neither n x nor the sum leaves them; else null."""
    out = []
    for x, total, n in zip(xs, totals, ns.to_pylist(), strict=True):
        x, total, value = x.values.to_numpy(), total.values.to_numpy(), None
        if len(total) and np.abs(x.astype(float)).max() * n < 2**62:
            apart = x * n - total
            if float((apart.astype(float) ** 2).sum()) < 2**63 - 2**20:
                value = int((apart * apart).sum())
        out.append(value)
    return pa.array(out, pa.int64())


def integers(vector: Column) -> Column:
    """floor(256 c) of each entry."""
    return F.transform(vector.cast("array<double>"), lambda c: F.floor(c * SCALE).cast("long"))


def _projected(row: Column) -> Column:
    """The product of x - centre with a row of the model; null for the row of a zero eigenvalue."""
    centred = F.zip_with("x", "centre", lambda a, b: a.cast("double") - b)
    return F.when(F.size(row) > 0, F.aggregate(F.zip_with(centred, row, lambda a, b: a * b), F.lit(0.0), lambda a, b: a + b))


def _with_model(rows: DataFrame, model: DataFrame) -> DataFrame:
    """rows (x, ...) beside the model of their length; where Spark does not broadcast the models, rows of one length meet it in SALTS places."""
    salted = rows.withColumn("salt", F.pmod(F.monotonically_increasing_id(), F.lit(SALTS))).withColumn("key", F.size("x").cast("long"))
    return salted.join(model.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)).cast("array<long>"))), ["key", "salt"]).drop("salt")


def fit(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """rows: (x). MODEL and identity_error for each length, fitted on each distinct vector once."""
    distinct = scratch.write(rows.where(F.size("x") > 0).select("x").distinct())
    states = covariance_states(distinct.select(F.size("x").cast("long").alias("key"), "x"), scratch)
    model = scratch.write(states.groupBy("key").applyInPandas(_solve, MODEL))
    white = F.filter(F.transform("whiten", _projected), lambda w: w.isNotNull())
    seen = covariance_states(_with_model(distinct, model).select("key", white.alias("w")), scratch)
    errors = seen.groupBy("key").applyInPandas(_distance, "of long, identity_error double")
    return scratch.write(model.join(errors, model.key == errors.of).drop("of"))


def whiten(table: DataFrame) -> DataFrame:
    """One row for each vector and component: vec_id, component, n, deviation, whitened, explained, identity_error."""
    importable(table.sparkSession)
    vector = F.col("embedding").cast("array<double>")
    whole = vector.isNotNull() & F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    rows = table.where(whole).select("vec_id", integers(F.col("embedding")).alias("x"))
    both = _with_model(rows, fit(rows, Scratch(table.sparkSession)))
    both = both.withColumn("deviation", F.arrow_udf(_deviation, "long")("x", "total", "n"))
    each = F.posexplode(F.arrays_zip(F.transform("whiten", _projected).alias("w"), F.col("explained").alias("e")))
    out = both.select("vec_id", "n", "deviation", "identity_error", each.alias("at", "c"))
    return out.select("vec_id", (F.col("at") + 1).alias("component"), "n", "deviation", F.col("c")["w"].alias("whitened"), F.col("c")["e"].alias("explained"), "identity_error")
