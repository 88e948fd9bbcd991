"""Operator 9: approximate nearest neighbours by learned partitions.

On a bounded sample a neighbour graph is built and partitioned evenly, and a small softmax classifier learns how a vector's
neighbours are spread over the partitions. The classifier assigns every row of the table to its most probable partition and sends
each query to its most probable partitions until their probabilities reach a mass that is calibrated on held-out sample vectors for
the wished recall, and until they hold k rows. What is found there is ranked by the exact inner product in double precision.
How many rows a query was compared with is a column of the result. Isotropic vectors have nothing to learn and most partitions are visited.

Large partitions are split into index blocks and their queries into query blocks, so that no task holds an unbounded group however
many rows or queries fall into one partition (copies of one vector all do).

Vectors of different lengths have no product, so each length is searched on its own: those with LEARNT vectors or more in the sample have a learned
partitioning each, any other length is one partition, in blocks like the rest.

Edge cases: vectors that are null, zero, or hold null or non-finite components take no part; a null vec_id takes no part; ties go to the smaller vec_id; rows that repeat a vec_id are queries of their own with
a list each, and candidates of each other; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import Scratch, importable

#: Rows that the partitions and the classifier are fitted on, at most.
SAMPLE = 4096
GRAPH_K = 20
#: Share of the true neighbours that calibration asks for; the contract's floor is 0.9.
RECALL = 0.94
#: Rows of an index block and queries of a query block, at most (about; rows are dealt by a hash).
BLOCK = 8192
#: Sample vectors of a length from which its partitions are learnt.
LEARNT = 256


@dataclass
class Router:
    """A softmax over partitions, and the probability mass to visit."""

    weights: np.ndarray
    bias: np.ndarray
    mass: float

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        z = x @ self.weights + self.bias
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return z / z.sum(axis=1, keepdims=True)

    def visits(self, x: np.ndarray, sizes: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Partitions by falling probability, how many of them to visit and how many rows these hold, at least `least` where there are as many."""
        p = self.probabilities(x)
        order = np.argsort(-p, axis=1, kind="stable")
        before = np.cumsum(np.take_along_axis(p, order, 1), axis=1) - np.take_along_axis(p, order, 1)
        rows = np.cumsum(sizes[order], axis=1)
        visits = np.maximum((before < self.mass).sum(axis=1), np.minimum((rows < least).sum(axis=1) + 1, len(sizes)))
        return order, visits, rows[np.arange(len(x)), visits - 1]


def neighbour_graph(x: np.ndarray, k: int) -> np.ndarray:
    """The k nearest rows of each row by inner product, itself excluded; computed in blocks."""
    out = np.empty((len(x), k), np.int64)
    for at in range(0, len(x), 512):
        s = x[at : at + 512] @ x.T
        s[np.arange(len(s)), at + np.arange(len(s))] = -np.inf
        out[at : at + 512] = np.argsort(-s, axis=1, kind="stable")[:, :k]
    return out


def balanced_partition(x: np.ndarray, graph: np.ndarray, parts: int, rng: np.random.Generator) -> np.ndarray:
    """Even parts that cut few edges: capacity-bound assignment to spread centres, then moves that lower the cut."""
    n, room = len(x), int(1.1 * len(x) / parts) + 1
    centres = x[rng.choice(n, parts, replace=False)]
    for _ in range(10):
        near = (x @ centres.T).argmax(axis=1)
        centres = np.array([x[near == p].mean(axis=0) if (near == p).any() else x[rng.integers(n)] for p in range(parts)])
        centres /= np.maximum(np.linalg.norm(centres, axis=1, keepdims=True), 1e-12)
    score = x @ centres.T
    label, load = np.full(n, -1), np.zeros(parts, np.int64)
    for i in np.argsort(-score.max(axis=1), kind="stable"):
        p = next(p for p in np.argsort(-score[i], kind="stable") if load[p] < room)
        label[i], load[p] = p, load[p] + 1
    friends: list[list[int]] = [row.tolist() for row in graph]
    for i, row in enumerate(graph):
        for j in row:
            friends[j].append(i)
    for _ in range(5):
        for i in rng.permutation(n):
            votes = np.bincount(label[friends[i]], minlength=parts)
            best = int(votes.argmax())
            if votes[best] > votes[label[i]] and load[best] < room:
                load[label[i]] -= 1
                load[best] += 1
                label[i] = best
    return label


def fit(x: np.ndarray, parts: int, recall: float = RECALL, seed: int = 0) -> Router:
    """Partition the sample's graph, learn the neighbours' spread with half of the sample, calibrate the mass with the other half."""
    x = np.unique(x, axis=0)
    rng = np.random.default_rng(seed)
    k = min(GRAPH_K, len(x) - 1)
    parts = max(1, min(parts, len(x) // 8))
    if k < 1 or parts == 1:
        return Router(np.zeros((x.shape[1], 1)), np.zeros(1), 1.1)
    graph = neighbour_graph(x, k)
    label = balanced_partition(x, graph, parts, rng)
    train = rng.random(len(x)) < 0.5
    goal = np.zeros((len(x), parts))
    np.add.at(goal, (np.repeat(np.arange(len(x)), k), label[graph].ravel()), 1.0)
    goal[np.arange(len(x)), label] += k
    goal /= goal.sum(axis=1, keepdims=True)
    router = Router(np.zeros((x.shape[1], parts)), np.zeros(parts), 1.1)
    m = [np.zeros_like(router.weights), np.zeros_like(router.weights), np.zeros(parts), np.zeros(parts)]
    for t in range(1, 201):
        d = (router.probabilities(x[train]) - goal[train]) / max(1, train.sum())
        for j, (value, g) in enumerate(((router.weights, x[train].T @ d), (router.bias, d.sum(axis=0)))):
            m[2 * j] = 0.9 * m[2 * j] + 0.1 * g
            m[2 * j + 1] = 0.99 * m[2 * j + 1] + 0.01 * g * g
            value -= 0.1 * (m[2 * j] / (1 - 0.9**t)) / (np.sqrt(m[2 * j + 1] / (1 - 0.99**t)) + 1e-9)
    own = router.probabilities(x).argmax(axis=1)
    p = router.probabilities(x[~train])
    order = np.argsort(-p, axis=1, kind="stable")
    before = np.cumsum(np.take_along_axis(p, order, 1), axis=1) - np.take_along_axis(p, order, 1)
    reach = np.empty_like(p)
    np.put_along_axis(reach, order, before, 1)
    # a neighbour in partition q is found when the mass exceeds what comes before q
    needed = np.sort(np.take_along_axis(reach, own[graph[~train]], 1).ravel())
    router.mass = float(needed[min(len(needed) - 1, int(np.ceil(recall * len(needed))))]) + 1e-9 if len(needed) else 1.1
    return router


def _matrix(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(np.float64) if len(column) else np.empty((0, 0))


def search(table: DataFrame, query_step: int = 20, k: int = 20, sample: int = SAMPLE, recall: float = RECALL, block: int = BLOCK, parts: int | None = None) -> DataFrame:
    """query_id, rank, vec_id, score, scanned: the k nearest rows found for each row whose vec_id is divisible by query_step; scanned: how many rows it was compared with."""
    spark = table.sparkSession
    importable(spark)
    scratch = Scratch(spark)
    valid = table.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>").alias("v")).where(
        "vec_id is not null and v is not null and size(v) > 0 and forall(v, x -> x is not null and not isnan(x) and abs(x) < double('Infinity')) and exists(v, x -> x != 0)"
    )
    drawn = [r["v"] for r in valid.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).select("v").collect()]
    empty = "query_id long, rank int, vec_id long, score double, scanned long"
    if not drawn:
        return spark.createDataFrame([], empty)
    lengths = pd.Series([len(v) for v in drawn]).value_counts()
    n = valid.count()
    # (router, number of its first partition) of each learnt length, at most SAMPLE / LEARNT of them; other lengths have the partition -length
    routers: dict[int, tuple[Router, int]] = {}
    first = 0
    for i, (width, share) in enumerate(sorted(lengths.items(), key=lambda x: (-x[1], x[0]))):
        if i == 0 or share >= LEARNT:
            router = fit(np.array([v for v in drawn if len(v) == width]), parts or int(np.clip(round((n * share / len(drawn)) ** 0.5 / 8), 16, 1024)), recall)
            routers[int(width)] = router, first
            first += len(router.bias)

    def by_length(f: pd.DataFrame, column: str) -> Iterator[tuple[int, pd.DataFrame]]:
        return ((int(width), g.copy()) for width, g in f.groupby(f[column].map(len), sort=True))

    def assign(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for width, g in by_length(f, "v"):
                router, at = routers.get(width, (None, 0))
                g["part"] = (router.probabilities(_matrix(g["v"])).argmax(axis=1) + at).astype("int32") if router else np.int32(-width)
                yield g

    numbered = valid.select(F.monotonically_increasing_id().alias("uid"), "vec_id", "v")
    rows = scratch.write(numbered.mapInPandas(assign, "uid long, vec_id long, v array<double>, part int"))
    # one row for each partition
    held = {r["part"]: r["n"] for r in rows.groupBy("part").agg(F.count("*").alias("n")).collect()}
    sizes = np.array([held.get(p, 0) for p in range(first)], np.int64)

    def route(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for width, g in by_length(f, "vector"):
                if width in routers:
                    router, at = routers[width]
                    own = sizes[at : at + len(router.bias)]
                    order, visits, seen = router.visits(_matrix(g["vector"]), own, k + 1)
                    g["part"] = [(o[:m][own[o[:m]] > 0] + at).astype("int32") for o, m in zip(order, visits, strict=True)]
                    g["scanned"] = seen - 1
                else:
                    g["part"] = [np.array([-width], "int32")] * len(g)
                    g["scanned"] = held[-width] - 1
                yield g

    asks = rows.where(F.col("vec_id") % query_step == 0).select(F.col("uid").alias("asking"), F.col("vec_id").alias("query_id"), F.col("v").alias("vector"))
    asks = scratch.write(asks.mapInPandas(route, "asking long, query_id long, vector array<double>, part array<int>, scanned long"))
    asked = asks.select("asking", "query_id", "vector", "scanned", F.explode("part").alias("part"))
    # how many blocks the index rows and the queries of a partition make
    blocks = asked.groupBy("part").agg(F.ceil(F.count("*") / block).alias("qb")).collect()
    blocks = F.broadcast(spark.createDataFrame([(r["part"], -(-held[r["part"]] // block), r["qb"]) for r in blocks], "part int, ib long, qb long"))
    some = lambda key, n: F.pmod(F.xxhash64(key), F.col(n))
    index = rows.join(blocks, "part").select("part", "uid", "vec_id", "v", some("uid", "ib").alias("i"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("qb") - 1)).alias("q"))
    asked = asked.join(blocks, "part").select("part", "asking", "query_id", "vector", "scanned", some("asking", "qb").alias("q"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("ib") - 1)).alias("i"))
    schema = "asking long, query_id long, scanned long, uid long, vec_id long, score double"
    columns = [c.split()[0] for c in schema.split(", ")]

    def rank(asks: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        if not len(asks) or not len(rows):
            return pd.DataFrame({c: [] for c in columns})
        q, v, ids, uids = _matrix(asks["vector"]), _matrix(rows["v"]), rows["vec_id"].to_numpy(), rows["uid"].to_numpy()
        out = []
        for at in range(0, len(q), 256):
            rough = q[at : at + 256] @ v.T
            names = (asks[c].to_numpy()[at : at + 256] for c in ("asking", "query_id", "scanned"))
            for asking, name, seen, vector, r in zip(*names, q[at : at + 256], rough, strict=True):
                r[uids == asking] = -np.inf
                least = np.partition(r, -k)[-k] if len(r) > k else -np.inf
                # the rough product may round otherwise for equal vectors, so what is close is ranked by a sum in a fixed order
                near = np.flatnonzero((r >= least - 1e-9 * max(1.0, abs(least))) & (r > -np.inf)) if least > -np.inf else np.flatnonzero(r > -np.inf)
                exact = (v[near] * vector).sum(axis=1)
                best = np.lexsort((uids[near], ids[near], -exact))[:k]
                out.append(pd.DataFrame({"asking": asking, "query_id": name, "scanned": seen, "uid": uids[near][best], "vec_id": ids[near][best], "score": exact[best]}))
        return pd.concat(out)

    found = asked.groupBy("part", "i", "q").cogroup(index.groupBy("part", "i", "q")).applyInPandas(rank, schema)
    best = F.row_number().over(Window.partitionBy("asking").orderBy(F.col("score").desc(), "vec_id", "uid"))
    return found.select("query_id", best.alias("rank"), "vec_id", "score", "scanned").where(F.col("rank") <= k)
