"""Sources, sinks, streams and plan shapes."""

import pytest
from pyspark.sql import functions as F

from statuta.functions import text
from statuta.operators import search, versions
from statuta.sources import html, pdf, remote, sinks, tables
from statuta.streaming import feed

DATA = "/root/testdata/sf0.001"


def test_malformed_records_are_rejected_not_lost(spark, tmp_path):
    (tmp_path / "r.json").write_text('{"id": 1, "n": "a"}\n{"id": "x"\n[1]\n{"id": 2, "n": null}\n')
    good, bad = tables.json_records(spark, str(tmp_path), "id long, n string")
    assert good.count() == 2 and bad.count() == 2


def test_files_are_never_overwritten(spark, tmp_path):
    sinks.save_new(spark.range(3), str(tmp_path / "x"))
    with pytest.raises(Exception, match="(?i)exists"):
        sinks.save_new(spark.range(3), str(tmp_path / "x"))


def test_missing_program_or_broken_file_is_a_row(spark, tmp_path):
    (tmp_path / "a.pdf").write_bytes(b"%PDF-1.7 broken")
    (tmp_path / "b.pdf").write_bytes(b"no pdf")
    found = pdf.files(spark, str(tmp_path))
    assert sorted(r["is_pdf"] for r in found.collect()) == [False, True]
    texts = pdf.page_texts(found, "no-such-program").collect()
    assert len(texts) == 2 and all(r["page"] == 0 and r["error"].startswith("no-such-program") for r in texts)
    ocr = pdf.ocr_texts(found.withColumn("page", F.lit(1)), render="no-such-program").collect()
    assert len(ocr) == 2 and all(r["text"] is None and r["error"] for r in ocr)


def test_full_html_form(spark):
    pages = spark.createDataFrame([("<p>art. 21<sup>1</sup> &sect; 2</p><script>x</script><ul><li>a<li>b</ul>",), (None,), ("",)], "html string")
    assert [r["text"] for r in html.with_text(pages).collect()] == ["art. 21 1 § 2\n\na\nb", None, ""]


def test_remote_source_is_one_partition_per_host(spark):
    reader = remote.RemoteReader({"urls": "https://a.x/1 https://b.x/2 https://a.x/3 http://c.x/4"})
    assert sorted(len(p.urls) for p in reader.partitions()) == [1, 1, 2]
    assert not remote.allowed("https://b.x/", "https://a.x/") and remote.allowed("https://a.x/2", "https://a.x/1") and not remote.allowed("http://a.x/")
    assert remote.wait_seconds(429, "90", 0) == 60 and remote.wait_seconds(404, None, 0) is None and remote.wait_seconds(503, None, 2) is None


def test_refused_address_is_a_row(spark):
    spark.dataSource.register(remote.RemoteSource)
    row = spark.read.format("statuta_remote").option("urls", "http://c.invalid/4").load().first()
    assert row["status"] == 0 and row["error"] == "only https is read"


def _run(stream, name, mode="append"):
    q = stream.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).start()
    q.awaitTermination()
    return q


def test_streams_agree_with_batch(spark, tmp_path):
    events = spark.read.parquet(f"{DATA}/events.parquet").select("event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id", "event_type")
    twice = events.unionByName(events)
    twice.write.parquet(str(tmp_path / "in"))
    stream = lambda: feed.read_feed(spark, str(tmp_path / "in"), twice.schema)
    _run(feed.unique_items(stream(), "event_id", "ts", "400 days"), "items")
    assert spark.table("items").count() == events.select("event_id").distinct().count()
    _run(feed.last_decisive(stream(), "user_id", "ts", F.col("event_type") == "purchase"), "decisive", "complete")
    batch = events.where("event_type = 'purchase'").groupBy("user_id").agg(F.max("ts").alias("decided"))
    assert spark.table("decisive").exceptAll(batch).count() == 0 and spark.table("decisive").count() == batch.count()
    _run(feed.counts(stream(), "ts", "event_type"), "counted", "update")
    assert spark.table("counted").agg(F.sum("n")).first()[0] == 2 * events.count()


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_filters_and_columns_reach_the_scan(spark):
    orders = tables.table(spark, DATA, "orders")
    plan = _plan(orders.where(search.meets(search.between(F.col("o_totalprice"), 10, 20), None, F.col("o_orderstatus") == "O")).select("o_orderkey"))
    assert "PushedFilters: [IsNotNull(o_totalprice), IsNotNull(o_orderstatus)" in plan and "o_orderpriority" not in plan


def test_page_is_a_bounded_top_k(spark):
    plan = _plan(search.page(tables.table(spark, DATA, "orders").select("o_orderkey"), [F.col("o_orderkey")], 3, 10))
    assert "TakeOrderedAndProject" in plan and "Exchange" not in plan


def test_interval_join_is_an_equi_join(spark):
    spans = spark.range(10).selectExpr("id as doc", "0L as s", "5L as e")
    assert "CartesianProduct" not in (plan := _plan(versions.overlapping(spans, spans, "doc", 10))) and "NestedLoop" not in plan


def test_pages_cover_the_list_exactly(spark):
    rows = spark.range(23).withColumn("g", F.col("id") % 3)
    pages = [[r["id"] for r in search.page(rows, [F.col("g"), F.col("id")], n, 5).collect()] for n in range(1, 7)]
    assert sum(pages, []) == [r["id"] for r in rows.orderBy("g", "id").collect()] and pages[-1] == []


def test_criteria():
    assert search.between(F.lit(1)) is None
    with pytest.raises(ValueError):
        search.meets(None)


@pytest.mark.parametrize(("given", "want"), [("a.c", ("a.c", "as written")), ("a++", ("a+", "superset")), (r"\mx", (r"\bx", "superset")), ("a(", (r"a\(", "literal"))])
def test_regex_dialect(given, want):
    assert text.regex_or_literal(given) == want


def test_keyword_scan(spark):
    """Stems, the keyword itself first, the limit, and nothing asked."""
    from statuta.operators import search

    names = spark.createDataFrame([(n,) for n in ("tax relief", "Taxation of income", "taxation", "income taxation", "taxation") + tuple(f"taxatio {i:02}" for i in range(20)) + (None,)], "name string")
    found = lambda asked, most=12: [tuple(r) for r in search.keyword_scan(names, "name", asked, most).collect()]
    assert found("taxation", 3) == [("taxation", True), ("Taxation of income", False), ("taxatio 00", False)]
    assert found("taxations income") == [("Taxation of income", False)]
    assert len(found("taxation")) == 12 and found(" ") == [] and found("duty") == []


def test_sessions_of_a_stream(spark, tmp_path):
    """Bursts of a case end after a pause; a late event that joins two bursts makes them one."""
    import datetime as dt

    from statuta.streaming import feed

    at = lambda m: dt.datetime(2024, 1, 1) + dt.timedelta(minutes=m)
    rows = [("a", at(0)), ("a", at(20)), ("a", at(100)), ("b", at(5)), ("a", at(110))]
    schema = "c string, at timestamp"
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = feed.sessions(feed.read_feed(spark, str(tmp_path / "in"), spark.createDataFrame([], schema).schema), "at", "c")
    query = stream.writeStream.format("memory").queryName("bursts").outputMode("complete").option("checkpointLocation", str(tmp_path / "at")).trigger(availableNow=True).start()
    assert query.awaitTermination(120)
    got = sorted((r["c"], r["session_window"]["start"], r["n"]) for r in spark.table("bursts").collect())
    assert got == [("a", at(0), 2), ("a", at(100), 2), ("b", at(5), 1)]


def test_decisions_of_raw_records(spark):
    """Shapes that are no decision are left out; entries without a date or a use say nothing."""
    from statuta.operators import verdicts

    good = '{"refid":"D.1","kind":"x","publication":{"status":"final","inforce":true},"parts":2,"dates":[{"date":"2022-04-19","use":"repealed"},{"date":"2025-12-11","use":"validation","scope":"*"},{"date":"soon","use":"trial"},{"date":"2026-01-01"}]}'
    rows = spark.createDataFrame([(x,) for x in (good, '{"refid":"D.2","dates":[]}', '{"kind":"x"}', "[1]", "no json", None)], "j string")
    found = tables.decisions(rows, "j")
    assert sorted((r["refid"], r["has_body"], r["in_force"]) for r in found.collect()) == [("D.1", True, True), ("D.2", False, None)]
    history = tables.control_history(found)
    assert sorted((r["refid"], r["use"]) for r in history.collect()) == [("D.1", "repealed"), ("D.1", "validation")]
    assert [tuple(r) for r in verdicts.legal_state(history, "refid").collect()] == [("D.1", "final")]
