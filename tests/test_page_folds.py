"""Folds over pages: they stream, whatever the number of pages, and give what a plain walk gives."""

import random

import pytest
from pyspark.sql import functions as F

from statuta.operators import boxes, layout, trees

LINES = "doc long, page int, line_no int, line string"
WORDS = "doc long, page int, seq int, x0 double, y0 double, x1 double, y1 double, word string"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _streams(df):
    plan = _plan(df)
    return "InPandas" not in plan and "Join" not in plan


@pytest.mark.parametrize("batch", [3, 10_000])
def test_columns_of_pages_that_batches_cut(spark, batch):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        rows = [(d, p, i, f"l{d}.{p}.{i}".ljust(20) + f"r{i}") for d in range(7) for p in (1, 2) for i in range(8)] + [(9, 1, 0, None), (9, 1, 1, " one line ")]
        random.Random(1).shuffle(rows)
        found = layout.column_order(spark.createDataFrame(rows, LINES))
        got = {(r["doc"], r["page"], r["line_no"]): r["line"] for r in found.collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    want = {(d, p, i): f"l{d}.{p}.{i}" if i < 8 else f"r{i - 8}" for d in range(7) for p in (1, 2) for i in range(16)} | {(9, 1, 0): "", (9, 1, 1): " one line"}
    assert got == want and _streams(found)


def test_uncertain_tables_stream(spark):
    table = lambda doc, *lines: [(doc, 1, i, x) for i, x in enumerate(lines)]
    rows = table(1, "a    b", "1    2", "3    4") + table(2, "a    b    c", "1    2    3", "   x    y", "4    5    6") + table(3, "text", "a    b", "1    2")
    found = layout.uncertain_tables(spark.createDataFrame(rows, LINES))
    assert {tuple(r) for r in found.collect()} == {(1, 1, 0, 2, False), (2, 1, 0, 3, True)} and _streams(found)


def test_words_with_one_place_have_an_order(spark):
    rows = [(1, 0, 1, 5.0, 0.0, 9.0, 8.0, w) for w in ("b", "a", "c")] + [(1, 0, 2, 0.0, 1.0, 4.0, 9.0, "12"), (1, 0, 3, 4.2, 1.0, 5.0, 4.0, "2")] + [(2, 0, 1, 0.0, 30.0, 1.0, 31.0, "z")]
    for seed in range(3):
        random.Random(seed).shuffle(rows)
        found = layout.words_to_lines(spark.createDataFrame(rows, WORDS).repartition(3))
        assert {tuple(r) for r in found.collect()} == {(1, 0, 0, 0.0, 0.0, 9.0, "12^2 a b c"), (2, 0, 0, 0.0, 30.0, 1.0, "z")} and _streams(found)


def test_margins_need_no_join(spark):
    lines = spark.range(50).select(F.col("id").alias("doc"), F.lit(1).alias("page"), F.explode(F.sequence(F.lit(0), F.lit(10))).alias("line_no"))
    lines = lines.withColumn("x0", F.when(F.col("line_no") == 10, 60.0).otherwise(0.0)).withColumn("x1", F.col("x0") + 50).withColumn("y0", F.col("line_no") % 10 * 1.0).withColumn("line", F.lit("x"))
    found = layout.margin_notes(lines)
    assert found.where("margin").count() == 50 and found.select("edge").distinct().collect()[0][0] == 50.0 and _streams(found)


def test_running_extremes_of_trees_only_grow(spark):
    tree = spark.createDataFrame([(1, 1, 0, 1, 3, "a"), (2, 1, 1, 2, 2, "b"), (3, 1, 1, 3, 3, "c")], "id int, root int, depth int, left long, right long, text string")
    found = trees.filtered(tree, F.col("text") == "b")
    assert {r["id"] for r in found.collect()} == {1, 2}
    assert "unboundedfollowing" not in _plan(found).lower()


@pytest.mark.parametrize("batch", [3, 10_000])
def test_notes_and_references_stream(spark, batch):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        rows = []
        for doc, page in [(d, p) for d in range(5) for p in (1, 2)] + [(9, None)]:
            rows += [(doc, page, i, 12.0 * i, 12.0 * i + 10, f"word{i + 1}) on") for i in range(4)]
            rows += [(doc, page, 4 + i, 80.0 + 8 * i, 86.0 + 8 * i, f"{i + 1}) note") for i in range(doc)]
        random.Random(2).shuffle(rows)
        marked = boxes.note_blocks(spark.createDataFrame(rows, "doc long, page int, line_no int, y0 double, y1 double, line string"))
        found = boxes.references(marked)
        inside = {(r["doc"], r["page"], r["line_no"]) for r in marked.where("in_note").collect()}
        got = sorted(tuple(r) for r in found.where("page is not null").collect())
        unnumbered = [tuple(r) for r in found.where("page is null").orderBy("number").collect()]
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert inside == {(d, p, 4 + i) for d in range(5) for p in (1, 2) for i in range(d)}
    assert got == sorted((d, p, i + 1, i, 4 + i if i < d else None) for d in range(5) for p in (1, 2) for i in range(4))
    # nothing is paired on a page without a number, and nothing is lost
    assert unnumbered == [(9, None, i + 1, i, None) for i in range(4)]
    assert _streams(found) and "Window" not in _plan(found)
