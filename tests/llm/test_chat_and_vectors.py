"""Chat formatting and nearest neighbours against plain forms."""

import random
from collections import defaultdict

import numpy as np
import pytest

from statuta.llm import chat, neighbours


def _want(rows, part=512):
    talks = defaultdict(list)
    for c, t, r, x, *_ in rows:
        talks[c].append((t is None, t or 0, r is None, r or "", x is None, x or "", r, x))
    said = {c: tuple((r, x) for *_, r, x in sorted(v, key=lambda v: v[:6])) for c, v in talks.items()}
    prefixes = {v[:k] for v in said.values() for k in range(1, len(v))}
    names = defaultdict(list)
    for c, v in said.items():
        names[v].append(c)
    out = []
    for v, cs in names.items():
        if v not in prefixes:
            stay = min(cs, key=lambda c: (c is None, c or 0))
            for k in range(0, len(v), part):
                out.append((stay, k // part, len(v), len(cs), "".join(f"<|{'user' if r is None else r}|>\n{x or ''}\n<|end|>\n" for r, x in v[k : k + part])))
    return out


def test_chat(spark):
    rng = random.Random(4)
    rows = []
    for c in range(60):
        talk = [("user", "hi")] + [(rng.choice(["user", "assistant", None]), rng.choice(["a", "b", None, ""])) for _ in range(rng.randint(0, 5))]
        rows += [(c, k * 3, r, x, "z") for k, (r, x) in enumerate(talk)]
    rows += [(None, 0, "user", "hi", "z"), (None, 3, "user", "null id", "z"), (99, None, "user", "late", "z"), (99, 5, "user", "early", "z"), (99, 5, "user", "early", "z")]
    rows += [(200, k, "user", str(k), "z") for k in range(1300)] + [(201, k, "user", str(k), "z") for k in range(1299)]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, n_turns string").repartition(4)
    key = lambda r: tuple((x is None, x if x is not None else 0) for x in r)
    assert sorted((tuple(r) for r in chat.render(table).collect()), key=key) == sorted(_want(rows), key=key)
    assert chat.render(table.limit(0)).count() == 0


def _brute(vectors, step, k):
    ids, x = np.array([i for i, _ in vectors]), np.array([v for _, v in vectors], float)
    out = {}
    for i in np.flatnonzero(ids % step == 0):
        s = (x * x[i]).sum(axis=1)
        s[ids == ids[i]] = -np.inf
        out[int(ids[i])] = [(int(ids[j]), s[j]) for j in np.lexsort((ids, -s)) if s[j] > -np.inf][:k]
    return out


def test_recall_on_the_given_table(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    want = _brute([(r["vec_id"], r["embedding"]) for r in table.collect()], 20, 20)
    got = defaultdict(list)
    for r in neighbours.search(table).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["vec_id"], r["score"]))
    hits = sum(len({v for v, _ in want[q]} & {v for v, _ in got[q]}) for q in want)
    assert set(got) == set(want) and hits >= 0.9 * sum(map(len, want.values()))
    for found in got.values():
        assert found == sorted(found, key=lambda x: (-x[1], x[0]))


def test_share_of_rows_scanned(spark):
    """Vectors in groups are found among few rows; the given vectors are isotropic, so most rows are read there."""
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(40, 16))
    rows = [(i, (3 * centres[i % 40] + rng.normal(size=16)).tolist()) for i in range(4000)]
    want = _brute(rows, 20, 20)
    got = neighbours.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    hits = sum(r["vec_id"] in {v for v, _ in want[r["query_id"]]} for r in got)
    assert hits >= 0.9 * sum(map(len, want.values())) and np.mean([r["scanned"] for r in got]) < 0.35 * len(rows)
    given = neighbours.search(spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")).select("scanned").collect()
    assert np.mean([r["scanned"] for r in given]) < 0.9 * 500


def test_repeated_ids_are_rows_of_their_own(spark):
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(size=6).tolist()) for i in range(200)]
    rows.append((20, rows[21][1]))
    got = defaultdict(list)
    for r in neighbours.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), parts=1).collect():
        got[r["query_id"]].append((r["vec_id"], round(r["score"], 9)))
    x = np.array([v for _, v in rows])
    want = []
    for i in (20, 200):
        s = (x * x[i]).sum(axis=1)
        s[i] = -np.inf
        want += [(rows[j][0], round(s[j], 9)) for j in np.lexsort(([r[0] for r in rows], -s))[:20]]
    assert sorted(got[20]) == sorted(want) and all(len(v) == 20 for q, v in got.items() if q != 20)


def test_queries_of_small_partitions_reach_k_rows(spark):
    """As many neighbours as there are, though the visited partitions are small."""
    rng = np.random.default_rng(6)
    rows = [(i, (8 * np.eye(8)[i % 8] + rng.normal(size=8)).tolist()) for i in range(100)]
    got = neighbours.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), query_step=5).groupBy("query_id").count().collect()
    assert len(got) == 20 and all(r["count"] == 20 for r in got)


def test_copies_ties_and_bad_vectors(spark):
    rng = np.random.default_rng(7)
    good = [(i, (v := rng.normal(size=8)).astype("float32").tolist()) for i in range(300)]
    good += [(1000 + i, [1.0] + [0.0] * 7) for i in range(400)]
    bad = [(2000, None), (2020, [0.0] * 8), (2040, [None] + [1.0] * 7), (2060, [float("nan")] + [1.0] * 7), (2080, [float("inf")] + [1.0] * 7), (None, [1.0] * 8), (2100, []), (2121, [1.0])]
    table = spark.createDataFrame([(i, v, 0, 1) for i, v in good + bad], "vec_id long, embedding array<float>, rank int, part int")
    want = _brute(good, 20, 20)
    got = defaultdict(list)
    for r in neighbours.search(table, block=64, parts=4).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["vec_id"], r["score"]))
    assert set(got) == set(want)
    for q in (1000, 1200):
        assert [v for v, _ in got[q]] == [v for v, _ in want[q]]
    hits = sum(len({v for v, _ in want[q]} & {v for v, _ in got[q]}) for q in want)
    assert hits >= 0.9 * sum(map(len, want.values()))


def test_each_length_is_searched(spark):
    rng = np.random.default_rng(9)
    rows = [(i, rng.normal(size=(8, 5, 3)[0 if i % 2 else 1 if i % 40 else 2]).tolist()) for i in range(1200)]
    got = defaultdict(list)
    for r in neighbours.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), block=100).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append(r["vec_id"])
    hits = total = 0
    for size in (8, 5, 3):
        want = _brute([r for r in rows if len(r[1]) == size], 20, 20)
        assert set(want) <= set(got) and all(len(got[q]) == len(want[q]) for q in want)
        hits += sum(len({v for v, _ in want[q]} & set(got[q])) for q in want)
        total += sum(map(len, want.values()))
    assert len(got) == 60 and hits >= 0.9 * total


@pytest.mark.parametrize("n", [0, 1, 2])
def test_tiny_tables(spark, n):
    table = spark.createDataFrame([(20 * i, [1.0, 2.0 + i]) for i in range(n)], "vec_id long, embedding array<float>")
    assert neighbours.search(table).count() == (2 if n == 2 else 0)
