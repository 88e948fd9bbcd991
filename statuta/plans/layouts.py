"""Queries on pages of boxes and lines, derived from the given tables, and on pages of long lists."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import boxes, canonical, layout, search
from .tables import query

_WORDS = """w AS (SELECT l_orderkey AS doc, CAST(l_linenumber % 2 AS INTEGER) AS page, l_linenumber * 1000000 + l_partkey AS seq, CAST(l_partkey % 60 AS DOUBLE) AS x0, CAST(l_suppkey % 40 AS DOUBLE) AS y0,
  l_partkey % 60 + l_quantity AS x1, CAST(l_suppkey % 40 + 6 + l_linenumber AS DOUBLE) AS y1, l_returnflag || l_linestatus AS word FROM lineitem)"""


def _words(t):
    """Lines of orders as boxes: two pages an order, places and sizes from their columns."""
    double = lambda c: c.cast("double")
    x, y = F.col("l_partkey") % 60, F.col("l_suppkey") % 40
    return t.lineitem.select(
        F.col("l_orderkey").alias("doc"), (F.col("l_linenumber") % 2).cast("int").alias("page"), (F.col("l_linenumber") * 1000000 + F.col("l_partkey")).alias("seq"),
        double(x).alias("x0"), double(y).alias("y0"), (x + F.col("l_quantity")).alias("x1"), double(y + 6 + F.col("l_linenumber")).alias("y1"), F.concat("l_returnflag", "l_linestatus").alias("word"),
    )


@query(f"""WITH {_WORDS}, p AS (SELECT a.doc, a.page, a.seq, b.seq AS seq_b, least(a.x1, b.x1) - greatest(a.x0, b.x0) AS wide, least(a.y1, b.y1) - greatest(a.y0, b.y0) AS high FROM w a JOIN w b ON a.doc = b.doc AND a.page = b.page AND a.seq < b.seq)
  SELECT doc, page, seq, seq_b, wide * high AS area FROM p WHERE wide > 0 AND high > 0""")
def overlapping_boxes(t):
    """X-17, X-15, J-11: boxes of a page with a common area, met on the cells of a grid."""
    words = _words(t)
    return boxes.overlapping(words, words).where("seq < seq_b").select("doc", "page", "seq", "seq_b", "area")


@query(f"""WITH {_WORDS}, p AS (SELECT a.doc, a.page, a.seq, a.word, b.seq AS b, b.word AS other, least(a.x1, b.x1) - greatest(a.x0, b.x0) AS wide, least(a.y1, b.y1) - greatest(a.y0, b.y0) AS high, (a.x1 - a.x0) * (a.y1 - a.y0) AS own FROM w a JOIN w b ON a.doc = b.doc AND a.page = b.page AND a.seq < b.seq)
  SELECT doc, page, seq, word, min(b) AS "by", arg_min(other, b) = word AS same FROM p WHERE wide > 0 AND high > 0 AND wide * high >= 0.5 * own GROUP BY doc, page, seq, word""")
def covered_words(t):
    """X-17: words that lie under a later one, as a hidden text layer does, and whether their text stands there too."""
    return boxes.covered(_words(t))


@query("""SELECT l_orderkey AS doc, CAST(0 AS INTEGER) AS page, line, count(*) AS copies, min(h) AS low, max(h) AS high, max(n) AS stays FROM (SELECT l_orderkey, 'text in ' || l_returnflag || l_linestatus || ' again' AS line, l_quantity AS h, l_linenumber AS n FROM lineitem)
  GROUP BY l_orderkey, line HAVING count(*) > 1 AND max(h) - min(h) > 0.5 AND max(h) > 1.05 * min(h)""")
def hidden_text_layer(t):
    """X-17: one text that a page has in two sizes; the last copy stays."""
    lines = t.lineitem.select(F.col("l_orderkey").alias("doc"), F.lit(0).alias("page"), F.concat(F.lit("text in "), "l_returnflag", "l_linestatus", F.lit(" again")).alias("line"), F.col("l_quantity").alias("h"), F.col("l_linenumber").alias("line_no"))
    return layout.hidden_layer(lines, F.col("h"))


@query("""WITH w AS (SELECT l_orderkey AS doc, l_linenumber * 1000000 + l_partkey AS seq, l_partkey % 60 AS x, l_suppkey % 40 AS y, CASE WHEN l_returnflag = 'N' THEN 30 ELSE 8 END AS wide, CASE WHEN l_returnflag = 'N' THEN 8 ELSE 30 END AS high FROM lineitem),
  p AS (SELECT doc, max(y + high) AS foot, count(*) >= 3 AND count(*) FILTER (high > wide) > 0.5 * count(*) AS turned FROM w GROUP BY doc)
  SELECT w.doc, seq, CAST(CASE WHEN turned THEN foot - y - high ELSE x END AS DOUBLE) AS x0, CAST(CASE WHEN turned THEN x ELSE y END AS DOUBLE) AS y0, CAST(CASE WHEN turned THEN foot - y ELSE x + wide END AS DOUBLE) AS x1, CAST(CASE WHEN turned THEN x + wide ELSE y + high END AS DOUBLE) AS y1, turned FROM w JOIN p ON p.doc = w.doc""")
def sideways_pages(t):
    """X-15: pages whose words stand sideways, turned before lines are made of them."""
    side = F.when(F.col("l_returnflag") == "N", F.struct(F.lit(30).alias("w"), F.lit(8).alias("h"))).otherwise(F.struct(F.lit(8).alias("w"), F.lit(30).alias("h")))
    x, y = F.col("l_partkey") % 60, F.col("l_suppkey") % 40
    corner = lambda c, name: c.cast("double").alias(name)
    words = t.lineitem.withColumn("side", side).select(
        F.col("l_orderkey").alias("doc"), F.lit(0).alias("page"), (F.col("l_linenumber") * 1000000 + F.col("l_partkey")).alias("seq"), corner(x, "x0"), corner(y, "y0"), corner(x + F.col("side.w"), "x1"), corner(y + F.col("side.h"), "y1"),
        F.lit("word").alias("word"),
    )
    return boxes.upright(words, least=3).select("doc", "seq", "x0", "y0", "x1", "y1", "turned")


_PAGES = """l AS (SELECT l_suppkey AS doc, CAST(year(l_shipdate) AS INTEGER) AS page, l_returnflag = 'R' AS note, row_number() OVER (PARTITION BY l_suppkey, year(l_shipdate), l_returnflag = 'R' ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey) AS i FROM lineitem),
  c AS (SELECT doc, page, count(*) FILTER (NOT note) AS b, count(*) FILTER (note) AS m FROM l GROUP BY 1, 2)"""


@query(f"""WITH {_PAGES}, r AS (SELECT l.doc, l.page, CAST(i AS INTEGER) AS number, CAST(i - 1 AS INTEGER) AS ref_line FROM l WHERE NOT note),
  n AS (SELECT l.doc, l.page, CAST(i AS INTEGER) AS number, CAST(b + i - 1 AS INTEGER) AS note_line FROM l JOIN c ON c.doc = l.doc AND c.page = l.page WHERE note AND b >= 1 AND b + m >= 3)
  SELECT coalesce(r.doc, n.doc) AS doc, coalesce(r.page, n.page) AS page, coalesce(r.number, n.number) AS number, ref_line, note_line FROM r FULL JOIN n ON r.doc = n.doc AND r.page = n.page AND r.number = n.number""")
def footnote_pairs(t):
    """X-18: blocks of notes found by the change of space and height from below, and references paired with them in order. What came back stands in
    smaller print at the foot of a supplier's page of a year."""
    from pyspark.sql import Window

    note = F.col("l_returnflag") == "R"
    rows = t.lineitem.select(F.col("l_suppkey").alias("doc"), F.year("l_shipdate").alias("page"), note.alias("note"), "l_shipdate", "l_orderkey", "l_linenumber", "l_partkey")
    # the body comes before the notes, so a running count has all of it where they begin
    order = Window.partitionBy("doc", "page").orderBy("note", "l_shipdate", "l_orderkey", "l_linenumber", "l_partkey")
    rows = rows.where("note is not null").withColumn("place", F.row_number().over(order)).withColumn("b", F.count_if(~F.col("note")).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    rows = rows.withColumn("i", F.when(F.col("note"), F.col("place") - F.col("b")).otherwise(F.col("place")))
    top = F.when(F.col("note"), 12 * F.col("b") + 20 + 8 * F.col("i")).otherwise(12 * F.col("i")).cast("double")
    text = F.when(F.col("note"), F.format_string("%d) treść przypisu", "i")).otherwise(F.format_string("słowo%d) dalej", "i"))
    lines = rows.select("doc", "page", (F.col("place") - 1).cast("int").alias("line_no"), top.alias("y0"), (top + F.when(F.col("note"), 6).otherwise(10)).alias("y1"), text.alias("line"))
    return boxes.references(boxes.note_blocks(lines))


_LINES = """a AS (SELECT doc_id, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS pos, unnest(string_split(text, chr(10))) AS line FROM documents), l AS (SELECT doc_id, pos, pos // 40 AS page, line FROM a)"""


@query(rf"""WITH {_LINES}, k AS (SELECT doc_id, count(DISTINCT page) AS pages FROM l GROUP BY 1),
  f AS (SELECT l.doc_id, regexp_replace(trim(line), '\d+', '#', 'g') AS shape FROM l JOIN k ON k.doc_id = l.doc_id WHERE trim(line) <> '' GROUP BY 1, 2, k.pages HAVING k.pages > 1 AND count(DISTINCT page) >= 0.6 * k.pages),
  s AS (SELECT * FROM l WHERE NOT EXISTS (SELECT 1 FROM f WHERE f.doc_id = l.doc_id AND f.shape = regexp_replace(trim(l.line), '\d+', '#', 'g'))),
  m AS (SELECT *, CASE WHEN coalesce(trim(lag(line) OVER (PARTITION BY doc_id ORDER BY pos)), '') = '' OR regexp_matches(line, '^ {{16}}') OR regexp_matches(trim(line), '\S {{3,}}\S') OR regexp_matches(line, '^\s*(?:Art\.|§|Rozdział|\d+[.)]|[a-z]\))') THEN 1 ELSE 0 END AS b FROM s),
  p AS (SELECT *, sum(b) OVER (PARTITION BY doc_id ORDER BY pos ROWS UNBOUNDED PRECEDING) AS para FROM m WHERE trim(line) <> '')
  SELECT doc_id AS doc, CAST(dense_rank() OVER (PARTITION BY doc_id ORDER BY para) AS INTEGER) AS para, CAST(min(page) AS INTEGER) AS first_page, CAST(max(page) AS INTEGER) AS last_page, md5(string_agg(trim(line), ' ' ORDER BY pos)) AS digest FROM p GROUP BY doc_id, para""")
def canonical_text(t):
    """X-21, X-12, X-13, X-14: documents printed on pages of forty lines, with a running head, read back: heads and lines that most pages share go, and
    paragraphs go on across pages."""
    rows = t.documents.select(F.col("doc_id").alias("doc"), F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    lines = rows.select("doc", F.floor(F.col("pos") / 40).cast("int").alias("page"), (F.col("pos") % 40 + 1).alias("line_no"), "line")
    more = rows.groupBy("doc").agg(F.max("pos").alias("last")).where("last >= 40").select("doc", F.explode(F.sequence(F.lit(0), F.floor(F.col("last") / 40).cast("int"))).alias("page"))
    heads = more.select("doc", "page", F.lit(0).alias("line_no"), F.format_string("Running head of these pages, page %d", F.col("page") + 1).alias("line"))
    made = canonical.canonical(lines.unionByName(heads))
    return made.where("kind = 'body'").select("doc", "para", "first_page", "last_page", F.md5("text").alias("digest"))


@query("""SELECT CAST(year(o_orderdate) AS INTEGER) AS year, o_orderkey, o_orderstatus FROM orders ORDER BY year(o_orderdate) DESC, o_orderkey LIMIT 50 OFFSET 100""")
def newest_first(t):
    """U-04, L-04: a page of all years, newest first, of which only the years that it needs are read."""
    rows = t.orders.select(F.year("o_orderdate").alias("year"), "o_orderkey", "o_orderstatus")
    return search.newest_first(rows, "year", [F.col("o_orderkey")], 3, 50)
