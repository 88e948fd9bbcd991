"""Queries on what acts and rulings say of units of other acts: texts made of the given tables, whose columns tell the oracle what was meant."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as texts_
from ..operators import passages, provisions
from .tables import query

DAY = "1998-01-01"


def _joined(rows: DataFrame, key: str, order: list[str], piece: Column, between: str = "") -> DataFrame:
    """(key, text): the pieces of each key in order."""
    parts = rows.select(key, F.struct(*order, piece.alias("_p")).alias("_s")).groupBy(key).agg(F.array_sort(F.collect_list("_s")).alias("_l"))
    return parts.select(key, F.array_join(F.transform("_l", lambda x: x["_p"]), between).alias("text"))


@query(r"""WITH c AS (SELECT conv_id, turn, role, coalesce(text, '') AS text, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS i, CASE WHEN role = 'user' THEN 1 ELSE -1 END AS step FROM conversations),
  s AS (SELECT *, sum(step) OVER (PARTITION BY conv_id ORDER BY i) AS total FROM c), m AS (SELECT *, total - least(0, min(total) OVER (PARTITION BY conv_id ORDER BY i)) AS depth FROM s),
  d AS (SELECT *, coalesce(lag(depth) OVER (PARTITION BY conv_id ORDER BY i), 0) AS before, regexp_replace(text, '[^\n]', ' ', 'g') AS blank FROM m)
  SELECT conv_id, md5(string_agg(CASE WHEN role = 'user' THEN ' ' || blank WHEN before > 0 THEN blank || ' ' ELSE text || '”' END, '' ORDER BY i)) AS digest, CAST(arg_max(depth, i) AS INTEGER) AS depth, CAST(least(1, arg_max(depth, i)) AS INTEGER) AS unsure FROM d GROUP BY conv_id""")
def quotation_depths(t):
    """X-07, W-06: nested and unclosed quotations as blanks. What a user says opens a quotation, the end of an answer closes one."""
    said = F.when(F.col("role") == "user", F.concat(F.lit("„"), F.coalesce("text", F.lit("")))).otherwise(F.concat(F.coalesce("text", F.lit("")), F.lit("”")))
    texts = _joined(t.conversations, "conv_id", ["turn", "role", "text"], said)
    found = texts.select("conv_id", provisions.quotations(F.col("text")).alias("q"))
    return found.select("conv_id", F.md5("q.masked").alias("digest"), "q.depth", F.size("q.unsure").alias("unsure"))


@query("""WITH l AS (SELECT l_orderkey, l_partkey % 300 + 1 AS article, l_suppkey, l_linenumber, l_returnflag, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_returnflag) AS INTEGER) AS point FROM lineitem),
  f AS (SELECT l_orderkey, l_suppkey AS first FROM l WHERE point = 1)
  SELECT l.l_orderkey, point, article::VARCHAR AS article, 'ustawy nr ' || CASE WHEN point > 1 AND l_linenumber % 2 = 0 THEN first ELSE l_suppkey END AS act, CASE WHEN l_returnflag = 'R' THEN 'void' ELSE 'valid' END AS verdict FROM l JOIN f ON l.l_orderkey = f.l_orderkey""")
def ruling_points(t):
    """X-09: points of operative parts: subject, act (of the point itself or of point 1 that it goes back to) and verdict, negated ones too."""
    number = F.row_number().over(Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_returnflag"))
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag").withColumn("point", number)
    act = F.when((F.col("point") > 1) & (F.col("l_linenumber") % 2 == 0), "ustawy powołanej w punkcie 1").otherwise(F.concat(F.lit("ustawy nr "), "l_suppkey"))
    verdict = F.when(F.col("l_returnflag") == "R", "jest niezgodny z art. 2 i art. 32 Konstytucji").when(F.col("l_returnflag") == "A", "nie jest niezgodny z art. 31 ust. 3 Konstytucji").otherwise("jest zgodny z art. 10 Konstytucji")
    clause = F.format_string("%d. Art. %d %s %s.", F.col("point"), F.col("l_partkey") % 300 + 1, act, verdict)
    texts = _joined(lines, "l_orderkey", ["point"], clause, " ")
    points = texts.select("l_orderkey", F.explode(provisions.operative_part(F.concat(F.lit("Trybunał orzeka: "), "text", F.lit(" Ponadto postanawia: umorzyć.")))).alias("p"))
    return points.select("l_orderkey", "p.point", F.array_join("p.keys", ",").alias("article"), "p.act", "p.verdict")


@query("""WITH l AS (SELECT l_orderkey, l_linenumber % 4 AS m, CAST(l_partkey % 50 + 1 AS INTEGER) AS a FROM lineitem),
  k AS (SELECT l_orderkey, unnest(CASE m WHEN 0 THEN [a::VARCHAR, (a + 2)::VARCHAR] WHEN 1 THEN [a::VARCHAR, (a + 1)::VARCHAR, (a + 2)::VARCHAR, (a + 3)::VARCHAR] WHEN 2 THEN [a || 'a'] ELSE [a || '^1', a || '^9b'] END) AS key FROM l)
  SELECT o.l_orderkey, keys, coalesce(ranges, '') AS ranges FROM (SELECT l_orderkey, string_agg(DISTINCT key, ',' ORDER BY key) AS keys FROM k GROUP BY 1) o
  LEFT JOIN (SELECT l_orderkey, string_agg(DISTINCT a || '^1..' || a || '^9b', ',' ORDER BY a || '^1..' || a || '^9b') AS ranges FROM l WHERE m = 3 GROUP BY 1) r ON r.l_orderkey = o.l_orderkey""")
def amending_acts(t):
    """X-07, X-08, I-13: articles that an amending act changes: lists, ranges spelled out and not, articles that quotations bring; none that a quotation
    only mentions, nor the place of an insertion."""
    a = (F.col("l_partkey") % 50 + 1).cast("int")
    m = F.col("l_linenumber") % 4
    clause = (
        F.when(m == 0, F.format_string("w art. %d i %d po wyrazach „art. 999 § 3” skreśla się wyraz;", a, a + 2)).when(m == 1, F.format_string("uchyla się art. %d–%d;", a, a + 3))
        .when(m == 2, F.format_string("po art. %d dodaje się przepis w brzmieniu:\n„Art. %da. O „nowym przepisie” mówi art. 888.”;", a, a)).otherwise(F.format_string("art. %d¹–%d⁹b otrzymują brzmienie;", a, a))
    )
    texts = _joined(t.lineitem, "l_orderkey", ["l_linenumber", "l_partkey", "l_suppkey"], clause, "\n")
    return texts.select("l_orderkey", provisions.changed_units(F.col("text")).alias("c")).select("l_orderkey", F.array_join("c.keys", ",").alias("keys"), F.array_join("c.ranges", ",").alias("ranges"))


@query(f"""WITH l AS (SELECT l_orderkey AS act, l_suppkey AS amendment, l_linenumber % 5 AS m, CAST(l_partkey % 50 + 1 AS BIGINT) AS a, l_shipdate > TIMESTAMP '{DAY}' AS later, l_returnflag FROM lineitem),
  c AS (SELECT * FROM l WHERE NOT EXISTS (SELECT 1 FROM l k WHERE k.act = l.act AND k.amendment = l.amendment AND k.l_returnflag = 'R')),
  q AS (SELECT DISTINCT o_orderkey AS act, CASE WHEN k < 5 THEN (1 + (o_orderkey * 7 + k * 11) % 50) ELSE 1 + o_orderkey % 50 END AS n, k = 5 AS raised FROM orders, range(0, 6) t(k)),
  h AS (SELECT q.act, n, raised, amendment, later FROM q JOIN c ON c.act = q.act AND CASE m WHEN 0 THEN NOT raised AND n IN (a, a + 2) WHEN 1 THEN NOT raised AND n BETWEEN a AND a + 3 WHEN 2 THEN raised AND n = a ELSE FALSE END),
  s AS (SELECT act, n, raised, count(DISTINCT amendment) FILTER (NOT later) AS now, count(DISTINCT amendment) FILTER (later) AS then FROM h GROUP BY 1, 2, 3),
  v AS (SELECT act, bool_or(NOT later) AS now, bool_or(later) AS then FROM c WHERE m >= 3 GROUP BY 1)
  SELECT q.act, q.n || CASE WHEN q.raised THEN '^5' ELSE '' END AS article, coalesce(s.now, 0) AS now, coalesce(s.then, 0) AS later,
  CASE WHEN s.now > 0 THEN 'CHANGED' WHEN v.now OR o.o_orderstatus = 'P' THEN 'UNSURE' WHEN s.then > 0 OR v.then THEN 'PENDING' ELSE 'CURRENT' END AS verdict
  FROM q JOIN orders o ON o.o_orderkey = q.act LEFT JOIN s ON s.act = q.act AND s.n = q.n AND s.raised = q.raised LEFT JOIN v ON v.act = q.act""")
def provision_currency(t):
    """V-02, J-12, X-08: articles asked for, against what the texts of later changes name: lists, ranges, ranges of raised numbers, whole acts, and
    changes that name nothing; by the day they enter into force."""
    n = lambda more: (F.col("l_partkey") % 50 + 1 + more).cast("string")
    m = F.col("l_linenumber") % 5
    text = (
        F.when(m == 0, F.concat(F.lit("w art. "), n(0), F.lit(" i "), n(2), F.lit(" skreśla się wyraz „art. 7”"))).when(m == 1, F.concat(F.lit("uchyla się art. "), n(0), F.lit("–"), n(3)))
        .when(m == 2, F.concat(F.lit("art. "), n(0), F.lit("¹–"), n(0), F.lit("⁹ otrzymują brzmienie"))).when(m == 3, "w całej ustawie wyraz „a” zastępuje się wyrazem „b”").otherwise("zmienia się załącznik")
    )
    lines = t.lineitem.select(F.col("l_orderkey").alias("act"), F.col("l_suppkey").alias("amendment"), F.col("l_shipdate").alias("entry"), "l_returnflag", "l_partkey", "l_linenumber")
    # texts are made and read of those changes only that the act's text lacks
    lacking = lines.join(lines.where("l_returnflag = 'R'").select("act", "amendment"), ["act", "amendment"], "left_anti")
    changes = provisions.change_rows(lacking.select("act", "amendment", "entry", text.alias("text")), F.col("text"))
    plain = [(1 + (F.col("o_orderkey") * 7 + k * 11) % 50).cast("string") for k in range(5)]
    asked = t.orders.select(F.col("o_orderkey").alias("act"), F.explode(F.array(*plain, F.concat((1 + F.col("o_orderkey") % 50).cast("string"), F.lit("^5")))).alias("article"))
    checked = t.orders.where("o_orderstatus != 'P'").select(F.col("o_orderkey").alias("act"))
    return provisions.currency(asked, changes, None, checked, F.lit(DAY).cast("timestamp"))


@query("""WITH l AS (SELECT l_orderkey, l_partkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS i FROM lineitem)
  SELECT l_orderkey, (2 * i)::VARCHAR AS article, 'Art. ' || 2 * i || '. Przepis o części ' || l_partkey || ' mówi:' || chr(10) || '„Art. 4. Nie ten.”' AS text FROM l WHERE i = 2
  UNION ALL SELECT l_orderkey, '§' || (2 * i + 1) AS article, '§ ' || (2 * i + 1) || '. Ustęp ' || l_partkey AS text FROM l WHERE i = 3""")
def unit_of_article(t):
    """X-04, I-12: the text of the article and of the paragraph that are asked for, from their headings to the next; what a quotation brings is no heading."""
    number = F.row_number().over(Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey"))
    rows = t.lineitem.select("l_orderkey", "l_partkey", number.alias("i"))
    unit = F.when(F.col("i") % 2 == 0, F.format_string("Art. %d. Przepis o części %d mówi:\n„Art. 4. Nie ten.”", 2 * F.col("i"), F.col("l_partkey"))).otherwise(F.format_string("§ %d. Ustęp %d", 2 * F.col("i") + 1, F.col("l_partkey")))
    texts = _joined(rows, "l_orderkey", ["i"], unit, "\n")
    asked = texts.select("l_orderkey", F.explode(F.array(F.lit("art. 4"), F.lit("§ 7"), F.lit("art. 41"))).alias("phrase"))
    return passages.unit_texts(texts, "l_orderkey", asked).select("l_orderkey", "article", "text")


@query("""WITH l AS (SELECT l_orderkey, l_partkey % 90 + 1 AS a, CAST(year(l_shipdate) AS VARCHAR) || '/' || l_suppkey AS act FROM lineitem)
  SELECT act, article, count(DISTINCT l_orderkey) AS judgments FROM (SELECT l_orderkey, act, unnest([a::VARCHAR, a || '^2']) AS article FROM l) GROUP BY 1, 2""")
def cited_in_judgments(t):
    """S-17, S-21, I-09: how many judgments cite a provision: articles with the journal position of their act, from the texts."""
    clause = F.format_string("na podstawie art. %d i art. %d² ustawy o drogach (Dz. U. z %d r. poz. %d)", F.col("l_partkey") % 90 + 1, F.col("l_partkey") % 90 + 1, F.year("l_shipdate"), F.col("l_suppkey"))
    texts = _joined(t.lineitem, "l_orderkey", ["l_linenumber", "l_partkey", "l_suppkey"], clause, ", ")
    cited = texts.select("l_orderkey", F.explode(passages.cited_provisions(F.col("text"))).alias("c")).select("l_orderkey", "c.*")
    return cited.groupBy("act", "article").agg(F.count_distinct("l_orderkey").alias("judgments"))


@query("""WITH p AS (SELECT l_orderkey AS doc, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS INTEGER) AS page, l_returnflag, count(*) OVER (PARTITION BY l_orderkey) AS n FROM lineitem)
  SELECT doc, page, 0 AS line_no, 'watermark' AS kind FROM p WHERE n > 1 UNION ALL SELECT doc, page, 2, 'contents' FROM p WHERE l_returnflag = 'R' UNION ALL SELECT doc, page, 3, 'number' FROM p""")
def page_noise(t):
    """X-12: watermarks, tables of contents and page numbers of the pages of orders."""
    rows = t.lineitem.select(F.col("l_orderkey").alias("doc"), F.row_number().over(Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey")).alias("page"), "l_partkey", "l_suppkey", "l_returnflag")
    word = F.concat(F.lit("treść "), F.translate(F.md5(F.concat_ws("-", "doc", "page", "l_partkey")), "0123456789", "ghijklmnop"))
    lines = F.array(F.lit("KOPIA URZĘDOWA 1/2"), word, F.when(F.col("l_returnflag") == "R", F.format_string("Rozdział %d ......... %d", F.col("l_partkey"), F.col("l_suppkey"))).otherwise(F.concat(word, F.lit(" dalej"))), F.format_string("– %d –", F.col("page")))
    return passages.page_noise(rows.select("doc", "page", F.posexplode(lines).alias("line_no", "line")))


@query("""WITH l AS (SELECT l_orderkey, l_partkey, l_suppkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS i FROM lineitem)
  SELECT l_orderkey, CAST(1 AS BIGINT) AS para, CAST(count(*) AS INTEGER) AS n_lines, string_agg(rpad('pozycja ' || l_partkey || ' ', 42, '.'), ' ' ORDER BY i) || ' ' || string_agg(l_suppkey || ',50', ' ' ORDER BY i) AS text FROM l GROUP BY 1""")
def amounts_at_end(t):
    """X-13: amounts in a column of their own go to the end of their paragraph."""
    number = F.row_number().over(Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey"))
    line = F.concat(F.rpad(F.format_string("pozycja %d ", F.col("l_partkey")), 42, "."), F.lit("    "), F.col("l_suppkey").cast("string"), F.lit(",50"))
    return passages.amounts_at_end(t.lineitem.select("l_orderkey", number.alias("line_no"), line.alias("line")), "l_orderkey")


@query(r"""WITH p AS (SELECT conv_id, coalesce(text, '') AS text, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS i, length(regexp_replace(coalesce(text, ''), '[^\p{L}\p{N}_]', '', 'g')) AS w FROM conversations),
  c AS (SELECT conv_id, count(*) AS n, sum(w) AS w, max(CASE WHEN i = 1 THEN w END) AS first, max(CASE WHEN i > 1 THEN w ELSE 0 END) AS rest, string_agg(text, chr(12) ORDER BY i) AS text FROM p GROUP BY 1)
  SELECT conv_id, array_to_string(list_filter([CASE WHEN trim(text) = '' THEN 'empty' END, CASE WHEN contains(text, chr(65533)) THEN 'undecodable characters' END, CASE WHEN w < 20 THEN 'almost no text' END, CASE WHEN NOT contains(text, '.') THEN 'no sentence' END,
    CASE WHEN n > 1 AND first >= 20 AND rest < 20 THEN 'only the first page has text' END, 'no unit'], lambda x: x IS NOT NULL), ', ') AS notes, w = 0 OR 100 * (length(text) - length(replace(text, chr(65533), ''))) > length(text) AS blocked FROM c""")
def text_verdicts(t):
    """X-05, A-08, A-10: what speaks against a text of several pages (the turns of a conversation), and whether it may be relied on at all."""
    texts = _joined(t.conversations, "conv_id", ["turn", "role", "text"], F.coalesce("text", F.lit("")), "\f")
    found = texts.select("conv_id", texts_.text_verdict(F.col("text")).alias("v"))
    return found.select("conv_id", F.array_join("v.notes", ", ").alias("notes"), "v.blocked")
