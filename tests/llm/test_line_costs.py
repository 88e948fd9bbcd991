"""Work that line dedup must not do twice, and that what is left out changes nothing."""

import random

from pyspark.sql import functions as F

from statuta.llm import buckets, components, line_dedup
from statuta.llm.shared import Scratch

LINE = "a sentence that is long enough to have a good many shingles of its own, so that one word more or less at its end leaves nearly all the others as they were, number"


def test_lines_are_made_plain_once_and_texts_hashed_once(spark, monkeypatch):
    """The passes over all lines: no filter lowers a line again, and the hash of a text is taken below the rows of its lines."""
    plans, write = [], Scratch.write
    monkeypatch.setattr(Scratch, "write", lambda self, df, *a, **k: plans.append(df._jdf.queryExecution().optimizedPlan().toString()) or write(self, df, *a, **k))
    docs = spark.createDataFrame([(1, "One line\nand one more"), (2, "one line\n\nanother")], "doc_id long, text string")
    assert sum(not r["kept"] for r in line_dedup.decisions(docs).collect()) == 1
    over_lines = [p for p in plans if "Generate posexplode(split(" in p]
    assert len(over_lines) == 2
    for p in over_lines:
        assert p.count("lower(") == 1
        assert "xxhash64(doc_id" not in p.partition("Generate posexplode(split(")[0] and "xxhash64(doc_id" in p


def test_signatures_of_lines_with_repeats(spark):
    """The smallest distinct hashes, also where the smallest repeat more often than the first look holds."""
    rng = random.Random(21)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(1, 20)))
    texts = [" ".join([word()] * n) for n in (1, 15, 16, 17, 40) for _ in range(10)]
    texts += [" ".join(rng.choice([word() + " " * 9] * 3 + [word()]) for _ in range(n)) for n in (5, 11, 12, 13, 30, 200) for _ in range(10)]
    for n in (3, 11, 12, 13, 20):
        some = [rng.choice("abcdefghij") * 8 + str(rng.random())[2:10] for _ in range(n)]
        texts += [" ".join(rng.choices(some, k=k)) for k in (16, 17, 60) for _ in range(10)]
    lines = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(None, "blank or short")], "id long, plain string")
    got = {r["id"]: r["low"] for r in line_dedup.signatures(lines, "id").collect()}
    want = {r["id"]: r["low"] for r in lines.select("id", F.slice(F.sort_array(line_dedup.shingles(F.col("plain"))), 1, line_dedup.SIGNATURE).alias("low")).collect()}
    assert got.pop(None) is None and want.pop(None) and got == want
    assert min(map(len, got.values())) < line_dedup.SIGNATURE == max(map(len, got.values()))


def test_links_added_to_components(spark, monkeypatch):
    """As if all were linked at once, and only links between different components are worked on."""
    rng = random.Random(22)
    first = [(rng.randrange(400), rng.randrange(400)) for _ in range(150)]
    more = [(rng.randrange(440), rng.randrange(440)) for _ in range(60)] + first[:40]
    frame = lambda edges: spark.createDataFrame(edges, "a long, b long")
    scratch, worked = Scratch(spark), []
    found = scratch.write(buckets.components(frame(first), scratch))
    want = {tuple(r) for r in buckets.components(frame(first + more), scratch).collect()}
    of = {r["node"]: r["component"] for r in found.collect()}
    plain = buckets.components
    monkeypatch.setattr(buckets, "components", lambda edges, s: worked.append({tuple(sorted(r)) for r in edges.collect() if r[0] != r[1]}) or plain(edges, s))
    assert sorted(map(tuple, buckets._merged(found, frame(more), scratch).collect())) == sorted(want)
    assert worked == [{tuple(sorted((of.get(a, a), of.get(b, b)))) for a, b in more if of.get(a, a) != of.get(b, b)}]
    assert {tuple(r) for r in buckets._merged(found, frame([]), scratch).collect()} == {tuple(r) for r in found.collect()}


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_only_texts_with_wanted_lines_are_sorted(spark, monkeypatch):
    """Texts meet the places of wanted lines in a join that hashes the short side; rows that repeat a document still give each line once."""
    plans, write = [], Scratch.write
    monkeypatch.setattr(Scratch, "write", lambda self, df, *a, **k: plans.append(_plan(df)) or write(self, df, *a, **k))
    docs = spark.createDataFrame([(1, f"{LINE} one\nalone"), (1, f"{LINE} one\nalone"), (2, f"other\n{LINE} two")], "doc_id long, text string")
    assert sorted(tuple(r) for r in line_dedup.decisions(docs).where("not kept").select("doc_id", "line_no").collect()) == [(1, 0), (1, 1), (2, 1)]
    texts = [p for p in plans if "first(text" in p]
    assert len(texts) == 1 and "ShuffledHashJoin [place" in texts[0]


def test_nodes_of_mixed_keys_need_no_second_join(spark, monkeypatch):
    """Pairs of different components under one key, as by brute force; the keys that have them are told by a window, not joined back."""
    rng = random.Random(23)
    own = sorted({(rng.randrange(60), rng.randrange(90)) for _ in range(240)})
    of = {n: rng.randrange(12) for n in range(0, 90, 2)}
    scratch, plans, write = Scratch(spark), [], Scratch.write
    members = scratch.write(spark.createDataFrame(own, "key long, node long"))
    found = scratch.write(spark.createDataFrame(list(of.items()), "node long, component long"))
    monkeypatch.setattr(Scratch, "write", lambda self, df, *a, **k: plans.append(_plan(df)) or write(self, df, *a, **k))
    got = {tuple(r) for r in buckets._unlinked(members, found, scratch).collect()}
    assert got == {(a, b) for k, a in own for l, b in own if k == l and a < b and of.get(a, a) != of.get(b, b)}
    assert len(plans) == 1 and plans[0].count("Join ") == 1 and "Window" in plans[0]


def test_hot_keys_are_parted_once(spark, monkeypatch):
    """Keys with many nodes are found in one pass over the shared ones; what is read afterwards is written with that mark."""
    plans, write = [], Scratch.write
    monkeypatch.setattr(Scratch, "write", lambda self, df, *a, **k: plans.append(df._jdf.queryExecution().optimizedPlan().toString()) or write(self, df, *a, **k))
    docs = spark.createDataFrame([(i, f"{LINE} {i}") for i in range(100, 140)] + [(i, f"{i} words that two lines have, and no other one among them") for i in (1, 2)], "doc_id long, text string")
    assert sorted(r["doc_id"] for r in line_dedup.decisions(docs).where("kept").collect()) == [1, 100]
    assert sum("hub" in p and "AS hot" in p for p in plans) == 1
    assert not any("LeftAnti, (key" in p for p in plans)


def test_large_star_is_not_shuffled_for_repeats(spark):
    """Repeats that a large star makes change no minimum; the small star after it drops them."""
    rng = random.Random(24)
    edges = {(max(a, b), min(a, b)) for a, b in ((rng.randrange(80), rng.randrange(80)) for _ in range(200)) if a != b}
    table = spark.createDataFrame(sorted(edges), "u long, v long")
    large = components._star(table, large=True)
    assert "hashpartitioning(u#" in _plan(large) and ", v#" not in "".join(x.split(")")[0] for x in _plan(large).split("hashpartitioning(")[1:])
    small = components._star(large, large=False).collect()
    assert len(small) == len(set(small))
    again = components._star(large.distinct(), large=False).collect()
    assert sorted(small) == sorted(again)
