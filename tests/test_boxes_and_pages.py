"""Boxes, note blocks, references in order, canonical text over pages, pages of long lists."""

import random
import time

from pyspark.sql import functions as F

from statuta.operators import boxes, canonical, search

WORDS = "doc long, page int, seq int, x0 double, y0 double, x1 double, y1 double, word string"


def test_overlap_against_all_pairs(spark):
    rng = random.Random(1)
    rows = []
    for i in range(300):
        x, y = rng.randint(-60, 200), rng.randint(0, 120)
        rows.append((rng.randint(1, 2), rng.randint(1, 2), i, float(x), float(y), x + float(rng.choice([0, 5, 24, 90])), y + float(rng.choice([3, 12, 60])), rng.choice("ab")))
    want = set()
    for a in rows:
        for b in rows:
            wide, high = min(a[5], b[5]) - max(a[3], b[3]), min(a[6], b[6]) - max(a[4], b[4])
            if a[:2] == b[:2] and wide > 0 and high > 0:
                want.add((a[2], b[2], wide * high))
    words = spark.createDataFrame(rows, WORDS)
    got = [(r["seq"], r["seq_b"], r["area"]) for r in boxes.overlapping(words, words, cell=16.0).collect()]
    assert len(got) == len(set(got)) and set(got) == want
    plan = boxes.overlapping(words, words)._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan


def test_covered(spark):
    rows = [(1, 1, 0, 0.0, 0.0, 10.0, 10.0, "a"), (1, 1, 1, 1.0, 1.0, 11.0, 11.0, "a"), (1, 1, 2, 50.0, 0.0, 60.0, 10.0, "b"), (1, 1, 3, 58.0, 0.0, 70.0, 10.0, "c"), (1, 2, 4, 0.0, 0.0, 9.0, 9.0, "a"), (1, 1, 5, 0.0, 0.0, 20.0, 20.0, "z")]
    got = sorted(tuple(r) for r in boxes.covered(spark.createDataFrame(rows, WORDS)).collect())
    assert got == [(1, 1, 0, "a", 1, True), (1, 1, 1, "a", 5, False)]


def test_sideways(spark):
    tall = [(1, 1, i, 10.0 * i, 100.0, 10.0 * i + 8, 160.0, "sideways") for i in range(12)]
    flat = [(1, 2, i, 0.0, 20.0 * i, 60.0, 20.0 * i + 8, "straight") for i in range(12)]
    got = {(r["page"], r["seq"]): r for r in boxes.upright(spark.createDataFrame(tall + flat, WORDS)).collect()}
    assert all(r["turned"] == (page == 1) and r["x1"] - r["x0"] == 60 and r["y1"] - r["y0"] == 8 for (page, _), r in got.items())
    assert [got[1, i]["y0"] for i in range(12)] == [10.0 * i for i in range(12)] and got[1, 0]["x0"] == 0.0


LINES = "doc long, page int, line_no int, y0 double, y1 double, line string"


def _page(doc, page, body, notes, space=30.0):
    out, y = [], 0.0
    for line in body:
        out.append((doc, page, len(out), y, y + 10, line))
        y += 12
    y += space
    for line in notes:
        out.append((doc, page, len(out), y, y + 6, line))
        y += 7
    return out


def test_note_blocks(spark):
    body = [f"line {i} of the text" for i in range(6)]
    rows = _page(1, 1, body, ["1) first note", "goes on", "2) second"]) + _page(1, 2, body, []) + _page(1, 3, body, ["no number", "2) late"]) + _page(2, 1, body, ["1) near"], space=0.0)
    got = {(r["doc"], r["page"], r["line_no"]) for r in boxes.note_blocks(spark.createDataFrame(rows, LINES)).where("in_note").collect()}
    assert got == {(1, 1, 6), (1, 1, 7), (1, 1, 8)}


def test_references_keep_their_order(spark):
    body = ["Art1) one.2) two3) x", "again1) and „q”4)", "5) a point, no reference", "last9)"]
    rows = _page(1, 1, body, ["1) a", "2) b", "4) d", "3) c", "1) a again", "7) nobody"]) + _page(1, 2, ["x1)", "y"], ["1) z"])
    got = sorted(tuple(r) for r in boxes.references(boxes.note_blocks(spark.createDataFrame(rows, LINES))).collect() if r["ref_line"] is not None and r["note_line"] is not None)
    # the second reference to 1 stands before that to 4, its note behind: one of the two goes
    assert [(p, n) for _, p, n, _, _ in got] in ([(1, 1), (1, 1), (1, 2), (1, 3), (2, 1)], [(1, 1), (1, 2), (1, 3), (1, 4), (2, 1)], [(1, 1), (1, 2), (1, 4), (2, 1)])
    every = boxes.references(boxes.note_blocks(spark.createDataFrame(rows, LINES))).collect()
    assert {(r["number"]) for r in every if r["ref_line"] is None} >= {7} and {r["number"] for r in every if r["note_line"] is None} >= {9}


def test_longest_rising():
    rng = random.Random(2)
    for _ in range(200):
        pairs = sorted((i, rng.randint(0, 9)) for i in range(rng.randint(0, 9)))
        kept = boxes._rising(pairs)
        values = [pairs[i][1] for i in kept]
        best = max((len(s) for m in range(2 ** len(pairs)) for s in [[p[1] for i, p in enumerate(pairs) if m >> i & 1]] if all(a < b for a, b in zip(s, s[1:]))), default=0)
        assert kept == sorted(kept) and all(a < b for a, b in zip(values, values[1:])) and len(kept) == best


def _read(spark, *docs, share=0.6):
    rows = [(d, p, n, line) for d, pages in enumerate(docs) for p, page in enumerate(pages) for n, line in enumerate(page)]
    random.Random(1).shuffle(rows)
    got = canonical.canonical(spark.createDataFrame(rows, "doc long, page int, line_no int, line string").repartition(3), share).orderBy("doc", "kind", "para").collect()
    return [[(r["kind"], r["first_page"], r["last_page"], r["text"]) for r in got if r["doc"] == d] for d in range(len(docs))]


def test_paragraphs_and_notes_over_pages(spark):
    first = ["Journal of laws, page 1", "Art. 1. A text that is", "broken in a para-", "graph and goes on", "", "", "1) a note that", "is not ended"]
    second = ["Journal of laws, page 2", "on the next page.", "", "Art. 2. New.", "Anna-", "Maria stays apart.", "", "", "______", "but goes on here", "2) second note"]
    third = ["Journal of laws, page 3", "", "The end."]
    (got,) = _read(spark, [first, second, third])
    assert got == [
        ("body", 0, 1, "Art. 1. A text that is broken in a paragraph and goes on on the next page."), ("body", 1, 1, "Art. 2. New. Anna- Maria stays apart."), ("body", 2, 2, "The end."),
        ("note", 0, 1, "1) a note that is not ended but goes on here"), ("note", 1, 1, "2) second note"),
    ]


def test_columns_over_pages(spark):
    left = [f"left column line {i}" for i in range(10)]
    right = [f"right column row {i}" for i in range(10)]
    pages = [["A TITLE THAT RUNS ACROSS BOTH OF THE COLUMNS"] + [f"{a:<28}{b}" for a, b in zip(left, right)], [f"{'short left':<28}{'short right'}"]]
    (got,) = _read(spark, pages)
    text = " ".join(x[3] for x in got)
    assert text == "A TITLE THAT RUNS ACROSS BOTH OF THE COLUMNS " + " ".join(left + right) + " short left short right"


def test_edges_of_pages(spark):
    assert _read(spark, [["", None, ""]], [["one"]], [[]])[:2] == [[], [("body", 0, 0, "one")]]
    empty = spark.createDataFrame([], "doc long, page int, line_no int, line string")
    assert canonical.canonical(empty).count() == 0


def test_newest_first_reads_the_years_it_needs(spark, tmp_path):
    rng = random.Random(3)
    rows = [(rng.choice([None, 2020, 2021, 2022, 2023, 2024]), i) for i in range(500)]
    spark.createDataFrame(rows, "year int, id int").write.partitionBy("year").parquet(str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t"))
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    for number in (1, 2, 3, 7, 11, 20):
        got = [(r["year"], r["id"]) for r in search.newest_first(table, "year", [F.col("id")], number, 50).collect()]
        assert got == order[(number - 1) * 50 : number * 50]
    page = search.newest_first(table, "year", [F.col("id")], 1, 50)
    page.collect()
    plan = page._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "2024" in plan and "2020" not in plan


def _gutter_by_columns(lines):
    full = [x for x in lines if x.strip()]
    width = max(len(x.rstrip()) for x in full)
    best, at = 0, None
    for c in range(int(0.35 * width), int(0.65 * width) + 1):
        free = [x for x in full if not x[c : c + 2].strip()]
        both = sum(bool(x[:c].strip() and x[c:].strip() and x[max(0, c - 1) : c + 2].strip() == "") for x in free)
        if len(free) >= 0.6 * len(full) and both >= 0.3 * len(full) and both > best:
            best, at = both, c
    return at


def test_gutter_is_looked_for_once_a_line():
    rng = random.Random(5)
    found = 0
    for _ in range(3000):
        n = rng.randint(1, 20)
        lines = ["".join(rng.choice("ab  \t") for _ in range(rng.randint(0, n))) + " " * rng.randint(0, 4) + "".join(rng.choice("cd \u00a0") for _ in range(rng.randint(0, n))) for _ in range(9)]
        full = [x for x in lines if x.strip()]
        if len(full) >= 8:
            want = _gutter_by_columns(lines)
            found += want is not None
            assert canonical.gutter(lines) == want
    assert found > 100
    # a page of long lines is read in time that grows with its length, not with columns times lines
    began = time.process_time()
    assert canonical.gutter(["a" * 50_000 + "    " + "b" * 50_000] * 40) == 50_001
    assert time.process_time() - began < 0.2
