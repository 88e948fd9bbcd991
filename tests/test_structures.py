"""Trees as nested intervals, graph patterns, paging with state, saved searches: against plain forms."""

import random

import pytest
from pyspark.sql import functions as F

from statuta.operators import graphs, paging, saved, trees
from statuta.plans import structures
from statuta.plans.tables import Tables


def _plain(nodes):
    """{node: (root, depth, left, right)} by walking down from the roots."""
    ids = {n for n, _ in nodes}
    below = {}
    for n, p in nodes:
        below.setdefault(p if p in ids else None, []).append(n)
    out = {}

    def walk(n, root, depth, at):
        left = at
        for c in sorted(below.get(n, [])):
            at = walk(c, root, depth + 1, at + 1)
        out[n] = (root, depth, left, at)
        return at

    for r in below.get(None, []):
        walk(r, r, 0, 1)
    return out


def test_nested_intervals_against_a_walk(spark):
    rng = random.Random(4)
    nodes = [(f"n{i:03}", f"n{rng.randint(max(0, i - 9), i - 1):03}" if i % 40 else None) for i in range(160)]  # deep, four roots
    nodes += [("x1", "gone"), ("y1", "y2"), ("y2", "y1"), ("y3", "y1"), ("z", "z")]  # an unknown parent, a cycle with a tail, a loop
    rng.shuffle(nodes)
    got = trees.nested_intervals(spark.createDataFrame(nodes, "id string, up string"), "id", "up").collect()
    want = {n: v for n, v in _plain(nodes).items()}
    assert {r["id"]: (r["root"], r["depth"], r["left"], r["right"]) for r in got} == want and max(v[1] for v in want.values()) > 8


def test_filter_keeps_ancestors(spark):
    rng = random.Random(5)
    nodes = [(i, rng.randint(0, i - 1) if i else None, rng.choice("abc")) for i in range(120)]
    up = {n: p for n, p, _ in nodes}
    path = lambda n: {n} | (path(up[n]) if up[n] is not None else set())
    tree = trees.nested_intervals(spark.createDataFrame(nodes, "id int, up int, text string"), "id", "up")
    hits = {n for n, _, t in nodes if t == "a"}
    above = set().union(*(path(n) for n in hits))
    assert {r["id"] for r in trees.filtered(tree, F.col("text") == "a").collect()} == above
    assert {r["id"] for r in trees.filtered(tree, F.col("text") == "a", below=True).collect()} == above | {n for n in up if path(n) & hits}
    assert trees.filtered(tree, F.col("text") == "none").count() == 0
    assert trees.nested_intervals(spark.createDataFrame([], "id int, up int"), "id", "up").count() == 0


def test_one_window_instead_of_a_join(spark):
    tree = spark.createDataFrame([(1, 1, 0, 1, 2, "a"), (2, 1, 1, 2, 2, "b")], "id int, root int, depth int, left long, right long, text string")
    plan = trees.filtered(tree, F.col("text") == "b", below=True)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan


def _all_matches(triples, patterns, wanted):
    rows = [{}]
    for p in patterns:
        out = []
        for b in rows:
            for t in triples:
                new = dict(b)
                if all(new.setdefault(x, v) == v if x.startswith("?") else x == v for x, v in zip(p, t)):
                    out.append(new)
        rows = out
    return {tuple(b["?" + w] for w in wanted) for b in rows}


@pytest.mark.parametrize(
    "patterns, wanted",
    [
        ([("?a", "p", "?b"), ("?b", "p", "?c"), ("?c", "q", "?d"), ("?d", "p", "?a")], ["a", "d"]), ([("?a", "p", "?a")], ["a"]), ([("?a", "?x", "1"), ("?a", "p", "?b")], ["x", "b"]),
        ([("?a", "p", "?b"), ("?a", "q", "?b")], ["a"]), ([("?a", "p", "?b"), ("1", "p", "2")], ["b"]), ([("?a", "none", "?b"), ("?b", "p", "?c")], ["c"]), ([("?a", "?p", "?b")], ["p"]),
    ],
)
def test_graph_patterns(spark, patterns, wanted):
    rng = random.Random(6)
    triples = sorted({(str(rng.randint(0, 7)), rng.choice("pq"), str(rng.randint(0, 7))) for _ in range(60)} | {("1", "p", "2"), ("3", "p", "3")})
    table = spark.createDataFrame(triples, "s string, p string, o string")
    assert {tuple(r) for r in graphs.match(table, patterns, wanted).collect()} == _all_matches(triples, patterns, wanted)


def test_patterns_need_shared_variables(spark):
    assert graphs.join_order([("?a", "p", "?b"), ("?b", "q", "?c"), ("?c", "r", "x")], [100, 50, 1]) == [2, 1, 0]
    table = spark.createDataFrame([("1", "p", "2")], "s string, p string, o string")
    with pytest.raises(ValueError):
        graphs.match(table, [("?a", "p", "?b"), ("?c", "p", "?d")], ["a"])
    with pytest.raises(ValueError):
        graphs.match(table, [("?a", "p", "?b")], ["x"])


def test_bindings_of_a_response(spark):
    rows = spark.createDataFrame([('{"results":{"bindings":[{"a":{"type":"uri","value":"x"},"b":{"value":"y"}},{"a":{"value":"z"}}]}}',), ('{"error":1}',), ("no json",), (None,)], "j string")
    got = [r["b"] for r in rows.select(graphs.bindings_of(F.col("j"), ["a", "b"]).alias("b")).collect()]
    assert [tuple(x) for x in got[0]] == [("x", "y"), ("z", None)] and got[1:] == [None, None, None]


ARRIVALS = "key string, round long, page long, total long, ids array<string>"


def _fold(spark, pages, **options):
    rows = spark.createDataFrame([("k", *p) for p in pages], ARRIVALS).repartition(3)
    (r,) = paging.paged(rows, "key", **options).collect()
    return r["round"], r["pages"], r["total"], r["seen"], r["restarts"], r["state"]


def test_paging(spark):
    assert _fold(spark, [(1, 1, 3, ["a", "b"]), (1, 2, 3, ["b"]), (2, 1, 3, ["c"]), (2, 2, 3, ["d"])]) == (2, 3, 3, 3, 0, "COMPLETE")
    # the total changes: what was collected goes, so an id that has left the list cannot stand in
    assert _fold(spark, [(1, 1, 3, ["a", "b"]), (1, 2, 2, ["c"]), (2, 1, 2, ["c"])]) == (2, 3, 2, 1, 1, "MORE")
    assert _fold(spark, [(1, 1, 2, ["a", "b", "c"]), (2, 1, 2, ["b", "c"])]) == (2, 2, 2, 2, 1, "COMPLETE")
    assert _fold(spark, [(r, 1, 3, ["a"]) for r in range(1, 9)], stall=3) == (4, 4, 3, 1, 0, "STALLED")
    assert _fold(spark, [(r, 1, 50, [str(r)]) for r in range(1, 9)], budget=5) == (5, 5, 50, 5, 0, "BUDGET")
    assert _fold(spark, [(1, 1, 99, ["a"])], most=50)[-1] == "TOO_MANY"
    assert _fold(spark, [(1, 1, None, None), (1, 2, 1, ["a"])]) == (1, 2, 1, 1, 0, "COMPLETE")
    assert _fold(spark, [(1, 1, 0, [])]) == (1, 1, 0, 0, 0, "COMPLETE")
    assert paging.paged(spark.createDataFrame([], ARRIVALS), "key").count() == 0


def test_paging_of_many_keys_and_as_a_stream(spark, tmp_path):
    rng = random.Random(9)
    pages = [(f"k{k}", r, p, rng.choice([4, 4, 4, 5]), [rng.choice("abcdef") for _ in range(2)]) for k in range(30) for r in range(1, 6) for p in range(1, 3)]
    want = {}
    for k in {p[0] for p in pages}:
        state = paging.Collected()
        for _, r, p, total, ids in sorted(x for x in pages if x[0] == k):
            state.page(r, total, ids, 3, 60, 10_000)
        state.end_round(3)
        want[k] = state.said()
    table = spark.createDataFrame(pages, ARRIVALS)
    assert {r["key"]: tuple(r)[1:] for r in paging.paged(table, "key").collect()} == want
    assert len({v[-1] for v in want.values()}) >= 2
    for r in range(1, 6):  # a round arrives at a time
        table.where(F.col("round") == r).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(table.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    query = paging.paged_stream(stream, "key").writeStream.format("memory").queryName("paged").outputMode("update").option("checkpointLocation", str(tmp_path / "at")).trigger(availableNow=True).start()
    assert query.awaitTermination(120)
    last = {}
    for r in spark.table("paged").collect():
        last[r["key"]] = max(last.get(r["key"], (0,)), (r["pages"], *tuple(r)[1:]))
    for k, said in want.items():
        if said[-1] in (paging.COMPLETE, paging.TOO_MANY):
            assert last[k][1:] == said


def test_saved_searches(spark):
    rng = random.Random(10)
    records = [(d, "own", {"n": str(rng.randint(0, 50)), "city": rng.choice(["Łódź", "Gdynia", "x"]), "day": f"20{rng.randint(10, 24)}-01-01"}) for d in range(150)]
    records += [(d, "party", {"name": rng.choice("abcd"), "share": str(rng.randint(0, 9))}) for d in range(150) for _ in range(rng.randint(0, 4))]
    records += [(500, "own", {"n": "many", "city": "x"})]
    searches = [
        (1, "own", "city", "eq", "x"), (1, "own", "n", "ge", "10"), (1, "own", "n", "le", "30"), (2, "party", "name", "eq", "a"), (2, "party", "name", "eq", "b"), (2, "party", "share", "ge", "5"), (2, "own", "city", "eq", "Gdynia"),
        (3, "own", "city", "has", "łó"), (3, "own", "day", "from", "2015-01-01"), (3, "own", "day", "to", "2020-01-01"), (4, "own", "city", "eq", "nowhere"), (5, "party", "share", "ge", "9"), (5, "own", "n", "eq", None), (6, "gone", "x", "eq", "1"),
    ]
    test = {"eq": lambda s, v: s == v, "has": lambda s, v: v.lower() in s.lower(), "ge": lambda s, v: s.isdigit() and float(s) >= float(v), "le": lambda s, v: s.isdigit() and float(s) <= float(v), "from": lambda s, v: s >= v, "to": lambda s, v: s <= v}
    want = set()
    for q in {s[0] for s in searches}:
        given = [s for s in searches if s[0] == q and s[4] is not None]
        for d in {r[0] for r in records}:
            ok = all(
                any(
                    all(any(f in e and test[op](e[f], v) for _, c, f2, o2, v in given if (c, f2, o2) == (section, f, op)) for f, op in {(f, op) for _, c, f, op, _ in given if c == section})
                    for d2, s2, e in records if d2 == d and s2 == section
                )
                for section in {s[1] for s in given}
            )
            if ok:
                want.add((q, d))
    r, s = spark.createDataFrame(records, "doc long, section string, fields map<string,string>"), spark.createDataFrame(searches, "search long, section string, field string, op string, value string")
    found = saved.matches(r, s)
    assert {(x["search"], x["doc"]) for x in found.collect()} == want and {q for q, _ in want} == {1, 2, 3, 5}
    keys = spark.createDataFrame([(1, "own", "n", True, True), (3, "own", "city", False, False), (5, "own", "day", False, True)], "search long, section string, field string, numeric boolean, descending boolean")
    got = saved.first_pages(found, keys, 3).collect()
    own = {d: e for d, section, e in records if section == "own"}
    order = {1: lambda d: (-float(own[d]["n"]), d), 2: lambda d: d, 3: lambda d: (own[d]["city"], d), 5: lambda d: (tuple(-ord(c) for c in own[d]["day"]), d)}
    for q in (1, 2, 3, 5):
        docs = sorted((d for q2, d in want if q2 == q), key=order[q])
        assert [(x["total"], x["doc"]) for x in sorted(got, key=lambda x: x["rank"]) if x["search"] == q] == [(len(docs), d) for d in docs[:3]]


def test_searches_have_no_cross_join(spark):
    plan = structures.saved_searches(Tables(spark, "/root/testdata/sf0.001"))._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan and "WindowGroupLimit" in plan


def test_searches_find_their_matches_once(spark):
    plan = structures.saved_searches(Tables(spark, "/root/testdata/sf0.001"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("forall(form") == 1
    # only fields that some search asks by equality become rows
    assert "explode(fields" not in plan and "explode(asked" in plan


def test_first_pages_count_all_shares(spark):
    found = spark.range(1000).selectExpr("id % 3 as search", "id as doc", "array(named_struct('section', 'own', 'fields', map('n', cast(id % 50 as string)))) as elements")
    keys = spark.createDataFrame([(0, "own", "n", True, True), (1, "own", "n", False, False)], "search long, section string, field string, numeric boolean, descending boolean")
    got = {q: [(r["total"], r["doc"]) for r in sorted(rows, key=lambda r: r["rank"])] for q in range(3) for rows in [[r for r in saved.first_pages(found, keys, 40).collect() if r["search"] == q]]}
    docs = lambda q: range(q, 1000, 3)
    order = {0: lambda d: (-(d % 50), d), 1: lambda d: (str(d % 50), d), 2: lambda d: d}
    assert got == {q: [(len(docs(q)), d) for d in sorted(docs(q), key=order[q])[:40]] for q in range(3)}
