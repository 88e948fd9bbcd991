"""Units of texts, cited provisions, noise of pages, amounts in a column, verdicts on texts, files that are never overwritten."""

import pytest
from pyspark.sql import functions as F

from statuta.functions import text
from statuta.operators import passages
from statuta.sources import sinks


def _texts(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "k int, text string")


def test_units_by_key(spark):
    act = "Tytuł\nArt. 5. Pierwszy\n  ust. 1\n[Art. 5a. Drugi\nArt. 5¹. Z indeksem\n„Art. 5. W cytacie\nArt. 6. też”\nArt. 6 7) Z przypisem\n§ 4. Paragraf\nArt. 50. Koniec"
    asked = spark.createDataFrame([(0, p) for p in ("art. 5", "art. 5a", "art. 5(1)", "art. 6", "§ 4", "art. 50", "art. 7", "rozdział", None)] + [(1, "art. 5"), (9, "art. 5")], "k int, phrase string")
    got = {(r["k"], r["article"]): (r["s"], r["text"]) for r in passages.unit_texts(_texts(spark, act, None), "k", asked).collect()}
    assert {k: v[1] for k, v in got.items()} == {
        (0, "5"): "Art. 5. Pierwszy\n  ust. 1", (0, "5a"): "[Art. 5a. Drugi", (0, "5^1"): "Art. 5¹. Z indeksem\n„Art. 5. W cytacie\nArt. 6. też”",
        (0, "6"): "Art. 6 7) Z przypisem", (0, "§4"): "§ 4. Paragraf", (0, "50"): "Art. 50. Koniec",
    }
    assert all(act[s : s + len(t)] == t for s, t in got.values())


def test_cited_provisions(spark):
    judgment = "art. 5 i 6 ustawy (Dz. U. z 2023 r. poz. 7), art. 4¹–4³ kodeksu (Dz. U. 1964 poz. 93 ze zm.) oraz art. 5 ustawy (Dz. U. z 2023 r. poz. 7); art. 99"
    got = [[(c["act"], c["article"]) for c in r["c"]] for r in _texts(spark, judgment, "nic", None).select("k", passages.cited_provisions(F.col("text")).alias("c")).orderBy("k").collect()]
    assert got == [[("2023/7", "5"), ("2023/7", "6"), ("1964/93", "4^1"), ("1964/93", "4^3"), (None, "99")], [], []]
    (few,) = _texts(spark, ", ".join(f"art. {i}" for i in range(1, 90))).select(passages.cited_provisions(F.col("text")).alias("c")).collect()
    assert len(few["c"]) == 40


def test_noise_of_pages(spark):
    pages = [["HEAD 1", "Spis ........ 5", "text of one", "- 1 -"], ["HEAD 2", "more", "text of two", "strona 2"], ["HEAD 3", "again", "1234 szt", "3"]]
    rows = spark.createDataFrame([(1, p, n, x) for p, page in enumerate(pages) for n, x in enumerate(page)] + [(2, 0, 0, "alone")], "doc int, page int, line_no int, line string")
    got = {(r["page"], r["line_no"]): r["kind"] for r in passages.page_noise(rows).collect()}
    assert got == {(0, 0): "watermark", (1, 0): "watermark", (2, 0): "watermark", (0, 1): "contents", (0, 3): "number", (1, 3): "number", (2, 3): "number"}


def test_amounts(spark):
    lines = ["1. First item with a text that is long enough", "that goes on to the next line of it.....    1 250,00", "and ends", "", "Second"]
    rows = spark.createDataFrame([(0, i, x) for i, x in enumerate(lines)], "k int, line_no int, line string")
    got = [r["text"] for r in passages.amounts_at_end(rows, "k").orderBy("para").collect()]
    assert got == ["1. First item with a text that is long enough that goes on to the next line of it..... and ends 1 250,00", "Second"]


def test_verdicts_on_texts(spark):
    rows = ["Art. 1. A text of one page that says enough.", "A first page that has enough of it.\f\f x", None, "a�b. " + "word " * 9, "§ 2. Lost � in many words. " + "word " * 40]
    got = [(r["v"]["notes"], r["v"]["blocked"]) for r in _texts(spark, *rows).select("k", text.text_verdict(F.col("text")).alias("v")).orderBy("k").collect()]
    assert got == [
        ([], False), (["only the first page has text", "no unit"], False), (["empty", "almost no text", "no unit"], True),
        (["undecodable characters", "no unit"], True), (["undecodable characters"], False),
    ]


def test_files_are_never_overwritten(spark, tmp_path):
    path = str(tmp_path / "out")
    sinks.save_new(spark.range(3), path)
    with pytest.raises(Exception, match="(?i)already exists"):
        sinks.save_new(spark.range(5), path)
    assert spark.read.parquet(path).count() == 3


def test_long_orders_have_no_third_unit(spark, tmp_path):
    """An order of twenty lines and more has an article 40; the query asks for one that no order has, as its SQL says."""
    import duckdb

    from statuta.plans import catalogue

    lines = spark.range(48).selectExpr("id % 2 as l_orderkey", "id as l_partkey", "id % 5 as l_suppkey", "cast(id as int) as l_linenumber")
    lines.coalesce(1).write.parquet(f"{tmp_path}/lineitem.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW lineitem AS SELECT * FROM '{tmp_path}/lineitem.parquet/*.parquet'")
    got = catalogue.queries()["unit_of_article"](spark, str(tmp_path)).select("l_orderkey", "article", "text").collect()
    assert sorted(map(tuple, got)) == sorted(con.execute(catalogue.oracle_sql()["unit_of_article"]).fetchall())


def test_noise_is_counted_without_joins(spark):
    rows = spark.createDataFrame([(1, 0, 0, "H 1"), (1, 0, 0, "H 2"), (1, 1, 0, "H 3"), (1, 2, 0, "other"), (1, None, 0, "H 4"), (1, 2, 1, " "), (None, 0, 0, "x"), (None, 1, 0, "x"), (3, 0, None, "y"), (3, 1, None, "y")], "doc int, page int, line_no int, line string")
    found = passages.page_noise(rows)
    # documents and places that are not known joined with nothing before; shapes there count like all others only where they are known
    assert sorted((r["page"] is None, r["page"] or 0, r["line_no"], r["kind"]) for r in found.where("doc = 1").collect()) == [(False, 0, 0, "watermark"), (False, 0, 0, "watermark"), (False, 1, 0, "watermark"), (True, 0, 0, "watermark")]
    assert found.where("doc is null or doc = 3").count() == 0
    assert "Join" not in found._jdf.queryExecution().executedPlan().toString()
