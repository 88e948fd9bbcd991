"""Queries over the whole tables, each with the SQL that says the same. DAY is the 'today' of all of them."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import dates, text, values
from ..operators import layout, passages, search, sequences, verdicts, versions
from ..sources import html, sinks, tables

DAY = "2024-01-15"
PHRASE, WORD = "the and", "tion"


@dataclass
class Tables:
    """The tables of a folder, read when asked for."""

    spark: SparkSession
    folder: str

    def __getattr__(self, name: str) -> DataFrame:
        return tables.table(self.spark, self.folder, name)

    def rows(self, schema: str, *rows: tuple) -> DataFrame:
        return self.spark.createDataFrame(list(rows), schema)


QUERIES: dict[str, tuple[Callable[[Tables], DataFrame], str]] = {}


def query(sql: str):
    def add(f):
        QUERIES[f.__name__] = (f, sql)
        return f

    return add


# --- scans, criteria, pages -------------------------------------------------------------------------------------------------

FOLD = "translate(lower(text), 'ąćęłńóśźżĄĆĘŁŃÓŚŹŻ', 'acelnoszzACELNOSZZ')"


@query(f"""SELECT doc_id, source, rank, total, 'FOUND' AS status FROM (
  SELECT doc_id, source, CAST(row_number() OVER (ORDER BY n_chars DESC, doc_id) AS INTEGER) AS rank, count(*) OVER () AS total
  FROM documents WHERE contains({FOLD}, '{PHRASE}')) WHERE rank BETWEEN 11 AND 20""")
def search_phrase_page(t):
    """F-02, L-02, L-04, V-01: one page of the documents with a phrase, with the total and a verdict."""
    hits = t.documents.where(text.has_phrase(F.col("text"), PHRASE)).select("doc_id", "source", "n_chars")
    total = hits.agg(F.count("*").alias("total"))
    shown = search.ranked_page(hits, [F.col("n_chars").desc(), F.col("doc_id")], 2, 10)
    return shown.join(total, F.lit(True)).select("doc_id", "source", "rank", "total", search.verdict(F.col("total"), F.lit(True)).alias("status"))


@query("""SELECT o_orderkey, o_custkey, o_orderpriority FROM orders JOIN customer ON o_custkey = c_custkey
  WHERE o_orderstatus = 'O' AND o_totalprice BETWEEN 100000 AND 200000 AND o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate < TIMESTAMP '1998-01-01' AND c_mktsegment = 'BUILDING'""")
def search_multi_criteria(t):
    """F-01, F-05, F-06: criteria that are not given are ignored."""
    when = F.col("o_orderdate")
    rows = t.orders.where(search.meets(F.col("o_orderstatus") == "O", search.between(F.col("o_totalprice"), 100000, 200000), search.between(when), (when >= F.lit("1996-01-01").cast("timestamp")) & (when < F.lit("1998-01-01").cast("timestamp"))))
    return rows.join(t.customer.where("c_mktsegment = 'BUILDING'"), F.col("o_custkey") == F.col("c_custkey"), "left_semi").select("o_orderkey", "o_custkey", "o_orderpriority")


@query("""SELECT DISTINCT p_partkey, p_name, p_type FROM part WHERE contains(lower(p_name), 'ring') AND starts_with(p_type, (SELECT min(p_type) FROM part)) ORDER BY p_partkey LIMIT 25""")
def title_search(t):
    """S-05, S-13: by substring and prefix, without repeats, the first 25."""
    first = t.part.agg(F.min("p_type").alias("least"))
    hits = t.part.where(F.contains(F.lower("p_name"), F.lit("ring"))).join(first, F.startswith("p_type", "least")).select("p_partkey", "p_name", "p_type").distinct()
    return search.page(hits, [F.col("p_partkey")], 1, 25)


@query("""SELECT CAST(year(o_orderdate) AS INTEGER) AS year, count(*) FILTER (o_orderstatus = 'F') AS hits, count(*) AS acts, max(o_orderkey) AS newest FROM orders GROUP BY 1""")
def year_scan_totals(t):
    """S-10, A-06, U-04: hits and acts of each year and the newest position."""
    return t.orders.groupBy(F.year("o_orderdate").alias("year")).agg(F.count_if(F.col("o_orderstatus") == "F").alias("hits"), F.count("*").alias("acts"), F.max("o_orderkey").alias("newest"))


@query("""SELECT d.source, d.total, coalesce(l.n, 0) AS fetched, d.total - coalesce(l.n, 0) AS missing, CASE WHEN d.total = coalesce(l.n, 0) THEN 'COMPLETE' ELSE 'UNKNOWN' END AS status
  FROM (SELECT source, count(*) AS total FROM documents GROUP BY source) d LEFT JOIN (SELECT source, count(*) AS n FROM documents JOIN labels USING (doc_id) GROUP BY source) l ON d.source = l.source""")
def completeness_check(t):
    """S-10, S-19, V-01: what was fetched against what is announced."""
    return tables.complete(t.documents.join(t.labels.select("doc_id"), "doc_id"), t.documents.groupBy("source").agg(F.count("*").alias("total")), "source")


@query("""SELECT s_suppkey, s_name, n_name, r_name FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""")
def dictionary_lookup(t):
    """S-31, J-06: labels from dimension tables, which Spark broadcasts by their size."""
    return t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey")).join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select("s_suppkey", "s_name", "n_name", "r_name")


@query("""SELECT q, CASE WHEN bool_or(lower(n_name) = lower(q)) OR count(n_name) = 1 THEN 'one' WHEN count(n_name) = 0 THEN 'none' ELSE 'many' END AS outcome,
  coalesce(max(CASE WHEN lower(n_name) = lower(q) THEN n_name END), CASE WHEN count(n_name) = 1 THEN min(n_name) END) AS name
  FROM (VALUES ('NATION_1'), ('nation_22'), ('x'), ('NATION_2')) t(q) LEFT JOIN nation ON starts_with(lower(n_name), lower(q)) GROUP BY q""")
def prefix_resolve(t):
    """F-09, S-18."""
    return search.resolve_prefix(t.rows("q string", ("NATION_1",), ("nation_22",), ("x",), ("NATION_2",)), t.nation.select(F.col("n_name").alias("name")))


@query("""SELECT p_partkey, p_brand FROM part WHERE p_brand IN ('Brand#12', 'Brand#23')""")
def category_alias_filter(t):
    """F-08."""
    return search.with_aliases(t.part, "p_brand", t.rows("alias string, id string", ("group", "Brand#12"), ("group", "Brand#23"), ("own", "Brand#23"))).select("p_partkey", "p_brand")


@query("""WITH h AS (SELECT s_suppkey, s_name, lower(s_name) = lower((SELECT min(s_name) FROM supplier)) AS e FROM supplier WHERE contains(lower(s_name), lower((SELECT min(s_name) FROM supplier))))
  SELECT s_suppkey, s_name, CASE WHEN e THEN 'exact' ELSE 'partial' END AS match FROM h WHERE e OR NOT (SELECT bool_or(e) FROM h)""")
def exact_after_fuzzy(t):
    """F-13: exact rows where there are any, else those with a fragment."""
    name = t.supplier.agg(F.min("s_name")).first()[0]  # what a user would ask for
    return search.exact_else_fragment(t.supplier.select("s_suppkey", "s_name"), "s_name", name)


@query("""SELECT doc_id, source FROM documents WHERE regexp_matches(text, '(tion|heit) und')""")
def regex_filter(t):
    """F-04, S-25: a pattern, rewritten from another dialect where needed."""
    pattern, _ = text.regex_or_literal("(tion|heit) und")
    return t.documents.where(F.col("text").rlike(pattern)).select("doc_id", "source")


@query("""SELECT event_id, user_id FROM events WHERE event_id > 0 AND event_type <> '' AND ts >= TIMESTAMP '2024-01-10' AND value IS NOT NULL""")
def drop_technical(t):
    """F-12: technical and empty rows go."""
    return t.events.where("event_id > 0 and event_type <> '' and ts >= timestamp'2024-01-10' and value is not null").select("event_id", "user_id")


@query(f"""SELECT user_id, max(ts) AS ts, arg_max(event_id, (ts, event_id)) AS event_id FROM events WHERE ts <= TIMESTAMP '{DAY}' GROUP BY user_id""")
def latest_not_future(t):
    """F-10, W-01."""
    return versions.latest_not_future(t.events.select("user_id", "ts", "event_id"), "user_id", "ts", DAY, "event_id")


@query(f"""SELECT event_id, ts, TRUE AS is_future FROM events WHERE ts > TIMESTAMP '{DAY}'""")
def future_versions(t):
    """F-10, F-11."""
    return versions.future_versions(t.events, "ts", DAY).select("event_id", "ts", dates.future(F.col("ts"), F.lit(DAY).cast("timestamp")).alias("is_future"))


@query(f"""SELECT event_type, max(ts) FILTER (ts <= TIMESTAMP '{DAY}') AS bound, CASE WHEN max(ts) FILTER (ts <= TIMESTAMP '{DAY}') IS NULL THEN 'UNKNOWN' WHEN TIMESTAMP '2024-01-14' > max(ts) FILTER (ts <= TIMESTAMP '{DAY}') THEN 'BEYOND' ELSE 'COVERED' END AS reach FROM events GROUP BY event_type""")
def freshness_bound(t):
    """A-09, V-10."""
    bound = t.events.groupBy("event_type").agg(F.max(F.when(F.col("ts") <= DAY, F.col("ts"))).alias("bound"))
    return bound.withColumn("reach", verdicts.beyond_collection(F.lit("2024-01-14").cast("timestamp"), F.col("bound")))


@query("""WITH c AS (SELECT c_nationkey, count(*) AS total FROM customer GROUP BY 1), a AS (SELECT s_suppkey, CAST(s_suppkey % 12 + 1 AS INTEGER) AS number, coalesce(total, 0) AS total FROM supplier LEFT JOIN c ON c_nationkey = s_nationkey),
  n AS (SELECT *, greatest(0, least(10, total - (number - 1) * 10)) AS rows FROM a)
  SELECT s_suppkey, number, total, rows, CASE WHEN rows > 0 THEN 'OK' WHEN total = 0 THEN 'VERIFIED_ABSENT' WHEN number * 10 >= 60 AND total > 60 THEN 'WINDOW_EXHAUSTED' ELSE 'BEYOND_END' END AS status FROM n""")
def empty_page_reason(t):
    """L-06: why a page of ten customers of a supplier's nation is empty: the pages are those that the list has."""
    listed = t.customer.select("c_nationkey", F.ceil(F.row_number().over(Window.partitionBy("c_nationkey").orderBy("c_custkey")) / 10).cast("int").alias("number"))
    pages = listed.groupBy("c_nationkey", "number").agg(F.count("*").alias("rows"))
    totals = t.customer.groupBy("c_nationkey").agg(F.count("*").alias("total"))
    asked = t.supplier.select("s_suppkey", F.col("s_nationkey").alias("c_nationkey"), (F.col("s_suppkey") % 12 + 1).cast("int").alias("number"))
    both = asked.join(pages, ["c_nationkey", "number"], "left").join(totals, "c_nationkey", "left").select("s_suppkey", "number", F.coalesce("total", F.lit(0).cast("long")).alias("total"), F.coalesce("rows", F.lit(0).cast("long")).alias("rows"))
    return both.withColumn("status", search.page_status(F.col("total"), F.col("number"), F.lit(10), F.col("rows"), window=60))


@query("""SELECT p_brand, p_partkey, rank FROM (SELECT p_brand, p_partkey, CAST(row_number() OVER (PARTITION BY p_brand ORDER BY p_retailprice DESC, p_partkey) AS INTEGER) AS rank FROM part) WHERE rank = 1""")
def hidden_base_rank(t):
    """L-07, L-01: the top row of each list by a total order."""
    rank = F.row_number().over(Window.partitionBy("p_brand").orderBy(F.col("p_retailprice").desc(), "p_partkey"))
    return t.part.withColumn("rank", rank).where("rank = 1").select("p_brand", "p_partkey", "rank")


@query("""SELECT count(DISTINCT event_id) AS seen, (SELECT count(DISTINCT event_id) FROM events) AS announced, CASE WHEN count(DISTINCT event_id) = (SELECT count(DISTINCT event_id) FROM events) THEN 'FOUND' ELSE 'UNKNOWN' END AS status
  FROM (SELECT event_id FROM events WHERE event_id % 10 < 7 UNION ALL SELECT event_id FROM events WHERE event_id % 10 > 2)""")
def union_of_rounds(t):
    """L-05: rounds of pages under an unstable order, united by id until the announced number is reached."""
    ids = t.events.select("event_id")
    seen = ids.where("event_id % 10 < 7").unionByName(ids.where("event_id % 10 > 2")).agg(F.count_distinct("event_id").alias("seen"))
    return seen.join(ids.agg(F.count_distinct("event_id").alias("announced")), F.lit(True)).withColumn("status", F.when(F.col("seen") == F.col("announced"), search.FOUND).otherwise(search.UNKNOWN))


@query("""SELECT q AS word, CAST(rank AS INTEGER) AS rank, name, CAST(d AS INTEGER) AS distance FROM (SELECT q, n_name AS name, levenshtein(lower(q), lower(n_name)) AS d, row_number() OVER (PARTITION BY q ORDER BY levenshtein(lower(q), lower(n_name)), n_name) AS rank
  FROM (VALUES ('NATION_77'), ('NASION_4')) t(q) JOIN nation ON levenshtein(lower(q), lower(n_name)) <= 2) WHERE rank <= 3""")
def suggestions(t):
    """D-13."""
    return search.suggestions(t.rows("word string", ("NATION_77",), ("NASION_4",)), t.nation.select(F.col("n_name").alias("name")))


# --- joins ---------------------------------------------------------------------------------------------------------------------


@query("""SELECT o_orderkey, o_custkey, n.d AS newest_o_orderdate, n.k AS newest_o_orderkey FROM orders JOIN (SELECT o_custkey AS c, max(o_orderdate) AS d, arg_max(o_orderkey, (o_orderdate, o_orderkey)) AS k FROM orders GROUP BY 1) n ON o_custkey = n.c WHERE (o_orderdate, o_orderkey) < (n.d, n.k)""")
def self_join_newer(t):
    """J-01, J-03: older texts with the newest one of their base."""
    return versions.newer_of_same_base(t.orders.select("o_orderkey", "o_custkey", "o_orderdate"), "o_custkey", ["o_orderdate", "o_orderkey"]).drop("o_orderdate")


@query("""SELECT coalesce(a.user_id, b.user_id) AS user_id, coalesce(a.first, b.first) AS first, CASE WHEN a.user_id IS NOT NULL AND b.user_id IS NOT NULL THEN 'both' WHEN a.user_id IS NOT NULL THEN 'own' ELSE 'base' END AS listed
  FROM (SELECT user_id, min(event_id) AS first FROM events WHERE event_type = 'purchase' GROUP BY 1) a FULL JOIN (SELECT user_id, min(event_id) AS first FROM events WHERE event_type = 'error' GROUP BY 1) b ON a.user_id = b.user_id""")
def amendments_full_outer(t):
    """J-02."""
    kind = lambda k: t.events.where(F.col("event_type") == k).groupBy("user_id").agg(F.min("event_id").alias("first"))
    return versions.merged_lists(kind("purchase"), kind("error"), "user_id", ["first"])


@query("""SELECT l_orderkey, l_linenumber FROM lineitem l WHERE NOT EXISTS (SELECT 1 FROM lineitem k WHERE k.l_orderkey = l.l_orderkey AND k.l_returnflag = 'R' AND k.l_linenumber <= l.l_linenumber)""")
def not_in_version_anti(t):
    """J-04: changes that neither their version nor an earlier one lists."""
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_returnflag")
    return versions.not_contained(rows.drop("l_returnflag"), rows.where("l_returnflag = 'R'"), ["l_orderkey"], "l_linenumber")


@query("""SELECT doc_id, lang FROM documents d WHERE EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id AND l.quality = 0)""")
def corrections_semi(t):
    """J-05."""
    return t.documents.select("doc_id", "lang").join(t.labels.where("quality = 0"), "doc_id", "left_semi")


@query("""SELECT c_custkey, n_name, n_name IS NOT NULL AS known FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey""")
def label_enrich(t):
    """J-06, S-06: labels for ids, and whether the id is known."""
    return t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"), "left").select("c_custkey", "n_name", F.col("n_name").isNotNull().alias("known"))


@query("""SELECT a.conv_id, a.turn, b.turn AS changed_by FROM conversations a JOIN conversations b ON a.conv_id = b.conv_id AND b.turn = a.turn + 1 WHERE a.role <> b.role""")
def reverse_links(t):
    """J-07: rows with the row that says it refers to them."""
    b = t.conversations.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("turn").alias("changed_by"), F.col("role").alias("r"))
    return t.conversations.join(b, ["conv_id", "turn"]).where("role <> r").select("conv_id", "turn", "changed_by")


@query("""SELECT page_id, regexp_extract(url, '^https?://([^/:?#]+)', 1) AS host, regexp_extract(url, '^https?://[^/]*(/[^?#]*)?', 1) AS path, regexp_extract(url, '[?&]id=([^&#]+)', 1) AS id FROM pages""")
def url_identity(t):
    """J-08, I-04, S-02: identity across sources from a URL's parts."""
    return t.pages.select("page_id", F.regexp_extract("url", r"^https?://([^/:?#]+)", 1).alias("host"), F.regexp_extract("url", r"^https?://[^/]*(/[^?#]*)?", 1).alias("path"), F.regexp_extract("url", r"[?&]id=([^&#]+)", 1).alias("id"))


@query("""SELECT n_nationkey, min(s_suppkey) AS s_suppkey FROM nation JOIN supplier ON n_nationkey = s_nationkey GROUP BY 1 HAVING count(DISTINCT s_suppkey) = 1""")
def unique_match_only(t):
    """J-09."""
    return versions.unique_match(t.nation.select("n_nationkey"), t.supplier.select(F.col("s_nationkey").alias("n_nationkey"), "s_suppkey"), ["n_nationkey"], "s_suppkey")


@query("""SELECT conv_id, turn, last_value(CASE WHEN role = 'user' THEN turn END IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn) AS unit FROM conversations""")
def enclosing_unit_asof(t):
    """J-10: as-of on position."""
    return versions.enclosing(t.conversations, "conv_id", "turn", F.when(F.col("role") == "user", F.col("turn")), "unit").select("conv_id", "turn", "unit")


@query("""SELECT a.user_id, a.s, a.e, b.s AS s2, b.e AS e2 FROM (SELECT user_id, floor(epoch(ts))::BIGINT AS s, floor(epoch(ts))::BIGINT + 3600 AS e FROM events WHERE event_type = 'click') a
  JOIN (SELECT user_id, floor(epoch(ts))::BIGINT AS s, floor(epoch(ts))::BIGINT + 7200 AS e FROM events WHERE event_type = 'error') b ON a.user_id = b.user_id AND a.s < b.e AND b.s < a.e""")
def span_overlap(t):
    """J-11: an interval join as an equi-join on cells."""
    span = lambda kind, n: t.events.where(F.col("event_type") == kind).select("user_id", F.unix_timestamp("ts").alias("s"), (F.unix_timestamp("ts") + n).alias("e"))
    return versions.overlapping(span("click", 3600), span("error", 7200), "user_id", 7200)


@query("""SELECT user_id, event_type, count(DISTINCT d) AS n, array_to_string(list_sort(list_distinct(list(d)))[1:20], ',') AS first FROM (SELECT user_id, event_type, CAST(ts AS DATE) AS d FROM events) GROUP BY 1, 2""")
def relations_by_kind(t):
    """A-01, U-01, S-07."""
    return versions.relations_by_kind(t.events.select("user_id", "event_type", F.to_date("ts").alias("d")), "user_id", "event_type", "d")


@query("""WITH RECURSIVE nodes AS (SELECT 'r' || r_regionkey AS id, NULL AS parent FROM region UNION ALL SELECT 'n' || n_nationkey, 'r' || n_regionkey FROM nation UNION ALL SELECT 's' || s_suppkey, 'n' || s_nationkey FROM supplier),
  tree AS (SELECT id, 0 AS depth, id AS path FROM nodes WHERE parent IS NULL UNION ALL SELECT n.id, t.depth + 1, t.path || '/' || n.id FROM nodes n JOIN tree t ON n.parent = t.id) SELECT id, CAST(depth AS INTEGER) AS depth, path FROM tree""")
def depth_tree(t):
    """S-08."""
    key = lambda p, c: F.concat(F.lit(p), F.col(c).cast("string"))
    nodes = t.region.select(key("r", "r_regionkey").alias("id"), F.lit(None).cast("string").alias("parent")).unionByName(t.nation.select(key("n", "n_nationkey").alias("id"), key("r", "n_regionkey").alias("parent")))
    return versions.depth_tree(nodes.unionByName(t.supplier.select(key("s", "s_suppkey").alias("id"), key("n", "s_nationkey").alias("parent"))), "id", "parent", 3)


@query("""SELECT CAST(year(o_orderdate) AS INTEGER) AS year, o_orderstatus AS publisher, count(*) AS acts, min(o_orderdate) AS first, max(o_orderdate) AS last FROM orders GROUP BY 1, 2""")
def catalogue_years(t):
    """S-09: publishers and years."""
    return t.orders.groupBy(F.year("o_orderdate").alias("year"), F.col("o_orderstatus").alias("publisher")).agg(F.count("*").alias("acts"), F.min("o_orderdate").alias("first"), F.max("o_orderdate").alias("last"))


@query("""SELECT d.doc_id, l.quality IS NOT NULL AS registered, coalesce(l.toxic, -1) AS status FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""")
def record_with_register(t):
    """S-11, S-26: a record with its entry in the register, where there is one."""
    return t.documents.select("doc_id").join(t.labels, "doc_id", "left").select("doc_id", F.col("quality").isNotNull().alias("registered"), F.coalesce("toxic", F.lit(-1)).alias("status"))


# --- aggregates and sets -------------------------------------------------------------------------------------------------------


@query("""SELECT p_brand, string_agg(DISTINCT p_type, ', ' ORDER BY p_type) AS types, count(DISTINCT p_size) AS sizes FROM part GROUP BY 1""")
def property_sets(t):
    """A-02, S-12: sets of each property, aggregated before any join."""
    return t.part.groupBy("p_brand").agg(F.array_join(F.sort_array(F.collect_set("p_type")), ", ").alias("types"), F.count_distinct("p_size").alias("sizes"))


@query("""SELECT line, count(DISTINCT source) AS sources FROM (SELECT split_part(text, chr(10), 1) AS line, source FROM documents) WHERE length(line) > 20 GROUP BY 1 HAVING count(DISTINCT source) > 1""")
def signature_collision(t):
    """A-03: one signature in several courts."""
    lines = t.documents.select(F.substring_index("text", "\n", 1).alias("line"), "source").where("length(line) > 20")
    return lines.groupBy("line").agg(F.count_distinct("source").alias("sources")).where("sources > 1")


@query("""SELECT quality, count(*) FILTER (toxic = 1) AS flagged, count(*) AS n FROM labels GROUP BY 1""")
def flag_counts(t):
    """A-04."""
    return t.labels.groupBy("quality").agg(F.count_if(F.col("toxic") == 1).alias("flagged"), F.count("*").alias("n"))


@query("""SELECT user_id, max(value) AS most, arg_max(event_id, (value, event_id)) AS event_id FROM events GROUP BY 1""")
def max_with_key(t):
    """A-05."""
    return t.events.groupBy("user_id").agg(F.max("value").alias("most"), F.max_by("event_id", F.struct("value", "event_id")).alias("event_id"))


@query("""SELECT l_shipmode, size, n FROM (SELECT l_linestatus AS l_shipmode, CAST(l_quantity AS INTEGER) AS size, count(*) AS n, row_number() OVER (PARTITION BY l_linestatus ORDER BY count(*) DESC, CAST(l_quantity AS INTEGER) DESC) AS r FROM lineitem GROUP BY 1, 2) WHERE r = 1""")
def mode_value(t):
    """A-07: the most frequent value, the larger of ties."""
    n = t.lineitem.groupBy(F.col("l_linestatus").alias("l_shipmode"), F.col("l_quantity").cast("int").alias("size")).agg(F.count("*").alias("n"))
    best = n.groupBy("l_shipmode").agg(F.max(F.struct("n", "size")).alias("b"))
    return best.select("l_shipmode", "b.size", "b.n")


@query("""SELECT doc_id, CAST(length(text) - length(replace(text, chr(65533), '')) AS BIGINT) AS lost, CAST(length(regexp_replace(text, '[^\\p{L}\\p{N}_]', '', 'g')) AS BIGINT) AS word_chars,
  array_to_string(list_filter([CASE WHEN trim(text) = '' THEN 'empty' END, CASE WHEN contains(text, chr(65533)) THEN 'undecodable characters' END, CASE WHEN length(regexp_replace(text, '[^\\p{L}\\p{N}_]', '', 'g')) < 20 THEN 'almost no text' END, CASE WHEN NOT contains(text, '.') THEN 'no sentence' END], lambda x: x IS NOT NULL), ', ') AS notes FROM documents""")
def text_quality(t):
    """A-08, A-10, X-05."""
    s = F.col("text")
    return t.documents.select("doc_id", text.replacement_chars(s).cast("long").alias("lost"), text.word_chars(s).cast("long").alias("word_chars"), F.array_join(text.quality_notes(s), ", ").alias("notes"))


@query("""SELECT c_custkey AS id, 'both' AS side FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders) UNION ALL SELECT c_custkey, 'only customer' FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)""")
def set_ops(t):
    """U-01, U-02, U-03: union, difference and intersection as sets."""
    a, b = t.customer.select(F.col("c_custkey").alias("id")), t.orders.select(F.col("o_custkey").alias("id"))
    return a.intersect(b).withColumn("side", F.lit("both")).unionByName(a.subtract(b).withColumn("side", F.lit("only customer")))


# --- sequences -------------------------------------------------------------------------------------------------------------------


@query("""SELECT l_orderkey, l_linenumber, last, finding FROM (SELECT *, CASE WHEN l_linenumber > last + 1 THEN 'gap' WHEN l_linenumber < last AND l_linenumber <> 1 THEN 'inversion' END AS finding FROM (
  SELECT l_orderkey, l_linenumber, lag(l_linenumber) OVER (PARTITION BY l_orderkey ORDER BY l_shipdate, l_linenumber, l_partkey) AS last FROM lineitem)) WHERE finding IS NOT NULL""")
def gap_inversion(t):
    """W-02."""
    return sequences.gaps(t.lineitem.select("l_orderkey", "l_linenumber", "l_shipdate", "l_partkey"), "l_orderkey", ["l_shipdate", "l_linenumber", "l_partkey"], "l_linenumber").drop("l_shipdate", "l_partkey")


@query("""SELECT user_id, string_agg(CASE WHEN a = b THEN a::VARCHAR ELSE a || '–' || b END, ', ' ORDER BY a) AS runs FROM (SELECT user_id, min(d) AS a, max(d) AS b FROM (
  SELECT user_id, d, d - row_number() OVER (PARTITION BY user_id ORDER BY d) AS i FROM (SELECT DISTINCT user_id, CAST(day(ts) AS INTEGER) AS d FROM events)) GROUP BY user_id, i) GROUP BY user_id""")
def run_compression(t):
    """W-03."""
    return sequences.runs(t.events.select("user_id", F.dayofmonth("ts").alias("d")), "user_id", "d")


@query("""SELECT user_id, ts, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS r FROM events) WHERE r = 1""")
def first_per_key(t):
    """W-04."""
    return sequences.first_per_key(t.events.select("user_id", "ts", "event_id", "event_type"), "user_id", ["ts", "event_id"])


@query("""WITH i AS (SELECT user_id, floor(epoch(ts))::BIGINT - 43200 AS s, floor(epoch(ts))::BIGINT + 43200 AS e FROM events), m AS (SELECT *, CASE WHEN s <= max(e) OVER (PARTITION BY user_id ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS n FROM i),
  g AS (SELECT *, sum(n) OVER (PARTITION BY user_id ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS k FROM m) SELECT user_id, min(s) AS s, max(e) AS e, count(*) AS merged FROM g GROUP BY user_id, k""")
def merge_intervals(t):
    """W-05."""
    at = F.unix_timestamp("ts")
    return sequences.merged_intervals(t.events.select("user_id", (at - 43200).alias("s"), (at + 43200).alias("e")), "user_id", "s", "e")


@query("""SELECT event_id, CAST(sum(CASE WHEN event_type = 'click' THEN 1 ELSE -1 END) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS depth FROM events""")
def running_depth(t):
    """W-06."""
    return sequences.running_depth(t.events, "user_id", ["ts", "event_id"], F.when(F.col("event_type") == "click", 1).otherwise(-1)).select("event_id", "depth")


@query("""WITH x AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, CAST(l_quantity AS INTEGER) % 4 AS q, l_returnflag = 'R' AS known FROM lineitem), n AS (SELECT *, CASE WHEN q = lag(q) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) + 1 THEN 0 ELSE 1 END AS b FROM x),
  r AS (SELECT *, sum(b) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice ROWS UNBOUNDED PRECEDING) AS run FROM n) SELECT l_orderkey, l_linenumber, l_partkey, bool_or(known) OVER (PARTITION BY l_orderkey, run) AS confirmed FROM r""")
def confirmed_markers(t):
    """W-07: confirmation by neighbours, as runs instead of a loop."""
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice").alias("at"), (F.col("l_quantity").cast("int") % 4).alias("q"), (F.col("l_returnflag") == "R").alias("known"))
    return sequences.confirmed_markers(rows, "l_orderkey", "at", "q", "known").select("l_orderkey", "l_linenumber", "l_partkey", "confirmed")


@query("""SELECT user_id, d AS decided, e AS tried, coalesce(e > d, e IS NOT NULL) AS open FROM (SELECT user_id, max(ts) FILTER (event_type = 'purchase') AS d, max(ts) FILTER (event_type = 'error') AS e FROM events GROUP BY 1)""")
def open_after_decisive(t):
    """W-08."""
    return sequences.open_after_decisive(t.events, "user_id", "ts", F.col("event_type") == "purchase", F.col("event_type") == "error")


@query("""SELECT l_orderkey, array_to_string(list_concat(p[1:1], list_sort(p[2:])), ',') AS parties FROM (SELECT l_orderkey, list(lpad(l_suppkey::VARCHAR, 6, '0') || l_returnflag ORDER BY l_linenumber, l_partkey, l_suppkey) AS p FROM lineitem GROUP BY 1)""")
def parties_stable_order(t):
    """L-03, F-07: the first party stays first, the rest is sorted."""
    party = F.concat(F.lpad(F.col("l_suppkey").cast("string"), 6, "0"), "l_returnflag").alias("p")
    arrays = t.lineitem.groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_suppkey", party))).alias("x"))
    return arrays.select("l_orderkey", F.array_join(values.party_order(F.transform("x", lambda s: s["p"])), ",").alias("parties"))


@query("""SELECT o_custkey, array_to_string(p[1:3], ', ') || CASE WHEN len(p) > 3 THEN ' (+' || (len(p) - 3) || ')' ELSE '' END AS newest FROM (SELECT o_custkey, list(o_orderkey ORDER BY o_orderkey DESC) AS p FROM orders GROUP BY 1)""")
def topk_more(t):
    """L-08: ranked before anything is collected, so that a list never holds more than it shows."""
    w = Window.partitionBy("o_custkey")
    top = t.orders.select("o_custkey", "o_orderkey", F.row_number().over(w.orderBy(F.col("o_orderkey").desc())).alias("i")).where("i <= 3")
    shown = top.groupBy("o_custkey").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("i", "o_orderkey"))), lambda x: x["o_orderkey"].cast("string")), ", ").alias("p"))
    more = t.orders.groupBy("o_custkey").agg((F.count("*") - 3).alias("more"))
    return shown.join(more, "o_custkey").select("o_custkey", F.concat("p", F.when(F.col("more") > 0, F.format_string(" (+%d)", "more")).otherwise("")).alias("newest"))


@query("""SELECT o_orderkey, buyer OR other AS any_role, buyer, other FROM (SELECT l_orderkey AS o_orderkey, bool_or(f = 1 AND l_suppkey % 7 = 0) AS buyer, bool_or(f > 1 AND l_suppkey % 7 = 0) AS other FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS f FROM lineitem) GROUP BY 1)""")
def party_roles(t):
    """F-07, S-29: the first party is the buyer; any = buyer or other."""
    first = F.row_number().over(Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey"))
    rows = t.lineitem.withColumn("f", first).groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.bool_or((F.col("f") == 1) & (F.col("l_suppkey") % 7 == 0)).alias("buyer"), F.bool_or((F.col("f") > 1) & (F.col("l_suppkey") % 7 == 0)).alias("other"))
    return rows.select("o_orderkey", (F.col("buyer") | F.col("other")).alias("any_role"), "buyer", "other")


# --- verdicts --------------------------------------------------------------------------------------------------------------------

USES = {"purchase": "validation", "signup": "defended", "error": "trial", "view": "repealed"}


LEGAL_STATE = """WITH h AS (SELECT user_id, ts AS tm, CASE event_type WHEN 'purchase' THEN 'validation' WHEN 'signup' THEN 'defended' WHEN 'error' THEN 'trial' WHEN 'view' THEN 'repealed' END AS kind, event_id % 3 = 0 AS part FROM events),
  p AS (SELECT user_id, max(tm) FILTER (kind = 'repealed') AS r, max(tm) FILTER (kind = 'validation') AS v, max(tm) FILTER (kind = 'validation' AND NOT part) AS f, max(tm) FILTER (kind = 'trial') AS t, max(tm) FILTER (kind IN ('defended', 'repealed', 'validation')) AS d,
    arg_max(NOT part, (tm, NOT part)) FILTER (kind = 'validation') AS l FROM h GROUP BY 1)
  SELECT user_id, CASE WHEN coalesce(t > d, t IS NOT NULL) THEN 'undetermined' WHEN r IS NOT NULL AND NOT coalesce(f > r, FALSE) THEN 'repealed' WHEN v IS NOT NULL AND NOT l THEN 'partial' WHEN v IS NOT NULL THEN 'final' ELSE 'active' END AS state FROM p"""


@query(LEGAL_STATE)
def legal_state(t):
    """V-05."""
    use = F.coalesce(*[F.when(F.col("event_type") == k, v) for k, v in USES.items()])
    return verdicts.legal_state(t.events.select("user_id", use.alias("use"), F.col("ts").alias("at"), F.when(F.col("event_id") % 3 == 0, "§ 1").alias("scope")), "user_id")


@query(LEGAL_STATE.replace("SELECT user_id, CASE", "SELECT 'D.' || user_id AS refid, count_in AS entries, CASE").replace("arg_max(NOT part", "count(kind) AS count_in, arg_max(NOT part"))
def decision_history(t):
    """S-25, S-26, V-05: decisions as raw JSON records, their control history read from the record, and the legal state that follows from it; the status
    that a record claims is not asked."""
    use = F.coalesce(*[F.when(F.col("event_type") == k, v) for k, v in USES.items()])
    entry = F.struct(F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("date"), use.alias("use"), F.lit("done").alias("status"), F.col("event_id").cast("string").alias("refid"), F.when(F.col("event_id") % 3 == 0, "§ 1").alias("scope"))
    per = t.events.groupBy("user_id").agg(F.collect_list(entry).alias("dates"))
    record = F.struct(F.concat(F.lit("D."), "user_id").alias("refid"), F.lit("decision").alias("kind"), F.struct(F.lit("final").alias("status"), F.lit(True).alias("inforce")).alias("publication"), F.lit(0).alias("parts"), "dates")
    found = tables.decisions(per.select(F.to_json(record).alias("json")), "json")
    history = tables.control_history(found)
    entries = history.groupBy("refid").agg(F.count("*").alias("entries"))
    states = verdicts.legal_state(history.unionByName(found.select("refid", F.lit(None).cast("timestamp").alias("at"), F.lit(None).cast("string").alias("use"), F.lit(None).cast("string").alias("by"), F.lit(None).cast("string").alias("scope"))), "refid")
    return states.join(entries, "refid", "left").select("refid", F.coalesce("entries", F.lit(0)).alias("entries"), "state")


@query("""SELECT d.doc_id, CASE WHEN l.doc_id IS NULL THEN NULL ELSE l.quality = 1 AND l.toxic = 0 END AS final FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""")
def finality_cautious(t):
    """V-06: null stays unknown, a contradiction is not final."""
    both = t.documents.select("doc_id").join(t.labels, "doc_id", "left")
    return both.select("doc_id", verdicts.finality(F.array(F.col("quality") == 1, F.col("toxic") == 0)).alias("final"))


@query("""SELECT c.c_custkey, coalesce(bool_or(o_orderstatus = 'P' OR o_orderpriority = '1-URGENT' OR l.o_orderkey IS NOT NULL), FALSE) AS undermined FROM customer c LEFT JOIN orders o ON o_custkey = c_custkey
  LEFT JOIN (SELECT DISTINCT l_orderkey AS o_orderkey FROM lineitem WHERE l_returnflag = 'R' AND l_quantity > 45) l ON l.o_orderkey = o.o_orderkey GROUP BY 1""")
def undermined(t):
    """V-07, U-02: by a comment that is not neutral, a status that is not current, or a link from what changes it."""
    changing = t.lineitem.where("l_returnflag = 'R' and l_quantity > 45").select(F.col("l_orderkey").alias("o_orderkey")).distinct().withColumn("link", F.lit(True))
    rulings = t.orders.select("o_orderkey", "o_custkey", "o_orderpriority", F.when(F.col("o_orderstatus") == "P", "zmieniona").otherwise("Aktualna").alias("status")).join(changing, "o_orderkey", "left")
    per = rulings.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.collect_set("o_orderpriority").alias("comments"), F.collect_set("status").alias("statuses"), F.coalesce(F.bool_or("link"), F.lit(False)).alias("linked"))
    found = verdicts.undermined(F.col("comments"), F.col("statuses"), "^[2-9]") | F.col("linked")
    return t.customer.select("c_custkey").join(per, "c_custkey", "left").select("c_custkey", F.coalesce(found, F.lit(False)).alias("undermined"))


KINDS = {"signup": "void_whole", "purchase": "repealed", "error": "void_part", "view": "corrected", "click": "amended"}


@query("""SELECT user_id, CASE max(r) WHEN 5 THEN 'void_whole' WHEN 4 THEN 'repealed' WHEN 3 THEN 'void_part' WHEN 2 THEN 'corrected' WHEN 1 THEN 'amended' ELSE 'none' END AS worst, max(r) = 5 AS blocked, count(*) AS n
  FROM (SELECT user_id, CASE event_type WHEN 'signup' THEN 5 WHEN 'purchase' THEN 4 WHEN 'error' THEN 3 WHEN 'view' THEN 2 WHEN 'click' THEN 1 ELSE 0 END AS r FROM events) GROUP BY 1""")
def relation_kind_rank(t):
    """V-08."""
    return verdicts.worst_relation(t.events, "user_id", F.coalesce(*[F.when(F.col("event_type") == k, v) for k, v in KINDS.items()]))


@query("""SELECT o_orderkey, o_orderstatus = 'O' AND bool_or(l_returnflag IN ('R', 'A')) AS contradiction FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY o_orderkey, o_orderstatus""")
def status_contradiction(t):
    """V-11."""
    kinds = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.collect_set("l_returnflag").alias("k"))
    return t.orders.select("o_orderkey", "o_orderstatus").join(kinds, "o_orderkey").select("o_orderkey", verdicts.contradicts(F.col("o_orderstatus") == "O", F.col("k"), "^[RA]$").alias("contradiction"))


@query("""SELECT c.name, coalesce(n, 0) AS total, CASE WHEN coalesce(n, 0) > 0 THEN 'FOUND' ELSE 'VERIFIED_ABSENT' END AS status, CASE WHEN coalesce(n, 0) = 0 AND c.least > 1000000 THEN 'size' ELSE '' END AS reasons
  FROM (VALUES ('all', 0), ('long', 5000), ('none', 9999999)) c(name, least) LEFT JOIN (SELECT c.name, count(*) AS n FROM documents JOIN (VALUES ('all', 0), ('long', 5000), ('none', 9999999)) c(name, least) ON n_chars >= c.least GROUP BY 1) k ON c.name = k.name""")
def zero_explained(t):
    """V-12, V-01: one row for each set of criteria, also those without hits."""
    criteria = {"all": 0, "long": 5000, "none": 9999999}
    counts = t.documents.agg(*[F.count_if(F.col("n_chars") >= n).alias(k) for k, n in criteria.items()])
    rows = counts.select(F.explode(F.array(*[F.struct(F.lit(k).alias("name"), F.lit(n).alias("least"), F.col(k).alias("total")) for k, n in criteria.items()])).alias("r")).select("r.*")
    return rows.select("name", "total", search.verdict(F.col("total"), F.lit(True)).alias("status"), search.zero_reasons(size=(F.col("total") == 0) & (F.col("least") > 1000000)).alias("reasons"))


@query(f"""SELECT l_orderkey, l_linenumber, CASE WHEN c IS NULL AND e THEN 'NOT_EXAMINED' WHEN NOT coalesce(c, FALSE) THEN 'UNCHANGED' WHEN e AND m THEN 'OLD_WORDING' WHEN e THEN 'CANNOT_TELL' ELSE 'FUTURE_CHANGE' END AS currency
  FROM (SELECT l_orderkey, l_linenumber, CASE l_returnflag WHEN 'R' THEN TRUE WHEN 'A' THEN FALSE END AS c, l_shipdate <= TIMESTAMP '1997-01-01' AS e, l_linestatus = 'F' AS m FROM lineitem)""")
def text_currency(t):
    """V-02: each change to a passage: does the text hold it."""
    changed = F.when(F.col("l_returnflag") == "R", True).when(F.col("l_returnflag") == "A", False)
    return t.lineitem.select("l_orderkey", "l_linenumber", verdicts.currency(changed, F.col("l_shipdate") <= F.lit("1997-01-01").cast("timestamp"), F.col("l_linestatus") == "F").alias("currency"))


@query("""SELECT o_custkey, o_orderkey, CASE WHEN o_orderdate > TIMESTAMP '1997-01-01' THEN 'FUTURE' WHEN o_orderstatus = 'P' AND n IS NOT NULL THEN 'BASE_HAS_CONSOLIDATION' WHEN o_orderdate < n THEN 'SUPERSEDED' ELSE 'CURRENT' END AS state
  FROM orders LEFT JOIN (SELECT o_custkey AS c, max(o_orderdate) AS n FROM orders WHERE o_orderdate <= TIMESTAMP '1997-01-01' GROUP BY 1) ON o_custkey = c""")
def version_states(t):
    """V-03, V-04, J-01."""
    day = F.lit("1997-01-01").cast("timestamp")
    newest = t.orders.where(F.col("o_orderdate") <= day).groupBy("o_custkey").agg(F.max("o_orderdate").alias("n"))
    return t.orders.join(newest, "o_custkey", "left").select("o_custkey", "o_orderkey", verdicts.version_state(F.col("o_orderdate"), F.col("n"), F.col("o_orderstatus") == "P", day).alias("state"))


@query("""SELECT o_orderkey, ['JUDGMENT', 'BOTH', 'REASONS', 'UNCLEAR', 'UNKNOWN'][1 + o_orderkey % 5] AS date_is,
  CASE WHEN o_orderdate > TIMESTAMP '1996-01-01' THEN 'NOT_YET' WHEN o_orderdate + INTERVAL 400 DAY > TIMESTAMP '1996-01-01' THEN 'PARTLY' ELSE 'IN_FORCE' END AS force FROM orders""")
def date_verdicts(t):
    """V-03, V-09: what a date of reasons is, against the portal's and the heading's, and whether an act with a staged entry is in force."""
    d, kind = F.col("o_orderdate"), F.col("o_orderkey") % 5
    portal = F.when(kind == 0, F.date_add(d, 31)).when(kind < 3, F.to_date(d)).when(kind == 3, F.date_add(d, -30))
    rows = t.orders.select("o_orderkey", F.to_date(d).alias("j"), portal.alias("p"), F.when(kind == 1, F.to_date(d)).alias("h"), F.array(F.to_date(d), F.date_add(d, 400)).alias("l"))
    day = F.lit("1996-01-01").cast("date")
    return rows.select("o_orderkey", verdicts.reasons_date(F.col("j"), F.col("p"), F.col("h")).alias("date_is"), verdicts.in_force(F.col("j"), F.col("l"), day).alias("force"))


@query("""SELECT event_id, ['proxy', 'timeout', 'no network', 'server', 'other'][1 + event_id % 5] AS class, CASE event_id % 4 WHEN 0 THEN 'OK' ELSE 'UNKNOWN' END AS shape FROM events""")
def failure_classes(t):
    """S-01, S-04: classes of transport failures, and shapes of list responses."""
    pick = lambda n, *said: F.element_at(F.array(*said), (F.col("event_id") % n + 1).cast("int"))
    error = F.concat(pick(5, *map(F.lit, ("Proxy answered 407", "read timed out", "Name or service not known", "HTTP 503", "odd"))), F.lit(" on "), "event_type")
    total = F.concat(F.lit('"totalResults":'), F.col("user_id").cast("string"), F.lit("}"))
    response = pick(4, F.concat(F.lit('{"items":[{"a":1}],'), total), F.concat(F.lit('{"items":{},'), total), F.lit('{"items":[]}'), F.lit("not json"))
    listed = F.when(tables.list_shape(response, "items", "totalResults") == "OK", "OK").otherwise("UNKNOWN")
    return t.events.select("event_id", verdicts.failure_class(error).alias("class"), listed.alias("shape"))


@query("""SELECT l_orderkey AS work, CASE min(CASE l_returnflag WHEN 'R' THEN 1 WHEN 'A' THEN 3 END) WHEN 1 THEN 'xhtml' ELSE 'pdf' END AS kind FROM lineitem WHERE l_returnflag <> 'N' GROUP BY l_orderkey""")
def preferred_manifestation(t):
    """S-14, S-15, S-34: the file by order of preference; kinds that are not in it never."""
    files = t.lineitem.select(F.col("l_orderkey").alias("work"), F.when(F.col("l_returnflag") == "R", "xhtml").when(F.col("l_returnflag") == "A", "pdf").otherwise("doc").alias("kind"))
    return tables.preferred(files, "work", "kind", ["xhtml", "html", "pdf"])


# --- texts -----------------------------------------------------------------------------------------------------------------------

STRIP = r"""regexp_replace(regexp_replace(regexp_replace(html, '<(script|style|button)\b.*?</(script|style|button)>', '', 'gis'), '<(br|/p|/div|/li|/tr|/h[1-6])[^>]*>', chr(10), 'gi'), '<[^>]*>', '', 'g')"""


@query(rf"""SELECT page_id, md5(regexp_replace(regexp_replace(regexp_replace(regexp_replace(translate(replace(replace(replace(replace(replace(replace({STRIP}, '&nbsp;', chr(160)), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&amp;', '&'),
  chr(160) || chr(9) || chr(13), '   '), ' +', ' ', 'g'), ' ?\n ?', chr(10), 'g'), '\n{{3,}}', chr(10) || chr(10), 'g'), '^[ \n]+|[ \n]+$', '', 'g')) AS digest FROM pages""")
def html_strip(t):
    """X-01, S-21, S-26."""
    return t.pages.select("page_id", F.md5(text.html_text(F.col("html"))).alias("digest"))


@query("""SELECT page_id, CAST(len(l) AS INTEGER) AS n, coalesce(l[1], '') AS first FROM (SELECT page_id, regexp_extract_all(html, '(?i)href="([^"]*)"', 1) AS l FROM pages)""")
def html_link_list(t):
    """S-19: how many links a page has, and the first."""
    return t.pages.select("page_id", F.size(html.links(F.col("html"))).alias("n"), F.coalesce(F.get(html.links(F.col("html")), F.lit(0)), F.lit("")).alias("first"))


@query(f"""WITH h AS (SELECT doc_id, length(text) AS n, unnest(string_split(lower(text), '{WORD}')) AS piece, generate_subscripts(string_split(lower(text), '{WORD}'), 1) - 1 AS i, len(string_split(lower(text), '{WORD}')) - 1 AS k FROM documents WHERE contains(lower(text), '{WORD}')),
  p AS (SELECT doc_id, n, i, k, sum(length(piece)) OVER (PARTITION BY doc_id ORDER BY i) + i * {len(WORD)} AS hit FROM h),
  s AS (SELECT doc_id, greatest(0, hit - 200) AS s, least(n, hit + {len(WORD)} + 600) AS e FROM p WHERE i < k),
  m AS (SELECT *, CASE WHEN s <= max(e) OVER (PARTITION BY doc_id ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS b FROM s),
  g AS (SELECT *, sum(b) OVER (PARTITION BY doc_id ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS w FROM m),
  f AS (SELECT doc_id, min(s) AS s, max(e) AS e, count(*) AS hits FROM g GROUP BY doc_id, w)
  SELECT doc_id, CAST(i AS INTEGER) AS i, CAST(s AS BIGINT) AS s, CAST(e AS BIGINT) AS e, hits FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY s) AS i FROM f) WHERE i <= 6""")
def kwic_windows(t):
    """X-02, W-05: six keyword windows of each document at most, as the feature has it."""
    return passages.keyword_windows(t.documents.select("doc_id", "text"), "doc_id", F.col("text"), WORD)


@query("""WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS n FROM documents),
  o AS (SELECT *, coalesce(sum(length(line) + 1) OVER (PARTITION BY doc_id ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS s FROM l), e AS (SELECT *, max(s + length(line)) OVER (PARTITION BY doc_id) AS last FROM o)
  SELECT doc_id, CAST(s AS BIGINT) AS s, CAST(coalesce(lead(s) OVER (PARTITION BY doc_id ORDER BY n) - 1, last) AS BIGINT) AS e, line AS heading FROM e WHERE length(line) BETWEEN 1 AND 40""")
def unit_spans(t):
    """X-04, X-20: a short line is a heading."""
    return passages.units(passages.lines(t.documents, "doc_id", F.col("text")), "doc_id", F.char_length("line").between(1, 40))


@query(r"""WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS n FROM documents),
  m AS (SELECT *, CASE WHEN coalesce(trim(lag(line) OVER (PARTITION BY doc_id ORDER BY n)), '') = '' OR regexp_matches(line, '^ {16}') OR regexp_matches(trim(line), '\S {3,}\S') OR regexp_matches(line, '^\s*(?:Art\.|§|Rozdział|\d+[.)]|[a-z]\))') THEN 1 ELSE 0 END AS b FROM l),
  p AS (SELECT *, sum(b) OVER (PARTITION BY doc_id ORDER BY n ROWS UNBOUNDED PRECEDING) AS para FROM m)
  SELECT doc_id, CAST(para AS BIGINT) AS para, CAST(count(*) AS INTEGER) AS n_lines, string_agg(trim(line), ' ' ORDER BY n) AS text FROM p WHERE trim(line) <> '' GROUP BY doc_id, para""")
def paragraph_join(t):
    """X-13."""
    return passages.paragraphs(passages.lines(t.documents, "doc_id", F.col("text")), "doc_id")


@query("""SELECT doc_id, line, count(*) AS copies, CAST(max(n) AS INTEGER) AS stays FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS n FROM documents) WHERE length(line) >= 10 GROUP BY 1, 2 HAVING count(*) > 1""")
def duplicate_layer(t):
    """X-17: a line that a document has several times; the last copy stays."""
    rows = passages.lines(t.documents, "doc_id", F.col("text")).where("char_length(line) >= 10")
    return rows.groupBy("doc_id", "line").agg(F.count("*").alias("copies"), F.max("line_no").alias("stays")).where("copies > 1")


@query(r"""SELECT source AS doc, shape, pages, total AS all_pages FROM (SELECT source, regexp_replace(trim(line), '\d+', '#', 'g') AS shape, count(DISTINCT doc_id) AS pages FROM (SELECT source, doc_id, unnest(string_split(text, chr(10))) AS line FROM documents) WHERE trim(line) <> '' GROUP BY 1, 2)
  JOIN (SELECT source AS s, count(DISTINCT doc_id) AS total FROM documents GROUP BY 1) ON source = s WHERE total > 1 AND pages >= 0.06 * total""")
def page_furniture(t):
    """X-12: lines that many pages of a document share."""
    rows = passages.lines(t.documents.select("source", "doc_id", "text").withColumn("k", F.struct("source", "doc_id")), "k", F.col("text"))
    pages = rows.select(F.col("k.source").alias("doc"), F.col("k.doc_id").alias("page"), "line")
    every = pages.groupBy("doc").agg(F.count_distinct("page").alias("all_pages"))
    return passages.page_furniture(pages, "doc", "page", F.col("line"), 0.06).join(every, "doc").select("doc", "shape", "pages", "all_pages")


@query("""SELECT event_id, json_extract_string(props, '$.ua') AS k, json_extract_string(props, '$.missing') AS absent FROM events""")
def json_props(t):
    """S-28, D-10."""
    return t.events.select("event_id", F.get_json_object("props", "$.ua").alias("k"), F.get_json_object("props", "$.missing").alias("absent"))


@query("""SELECT CASE WHEN length(x) > 40 THEN left(x, 39) || '…' ELSE x END AS line FROM (SELECT concat_ws(' | ', o_orderkey::VARCHAR, o_orderstatus, o_orderpriority, o_custkey::VARCHAR) AS x FROM orders)""")
def listing(t):
    """K-01."""
    return sinks.listing(t.orders, ["o_orderkey", "o_orderstatus", "o_orderpriority", "o_custkey"], 40)


@query("""SELECT '{"n_nationkey":' || n_nationkey || ',"n_name":"' || n_name || '","n_regionkey":' || n_regionkey || '}' AS json FROM nation""")
def raw_json(t):
    """K-02."""
    return sinks.raw_json(t.nation.select("n_nationkey", "n_name", "n_regionkey"))


@query("""SELECT c_custkey, CASE c_custkey % 3 WHEN 2 THEN '' ELSE 'court: ' || c_mktsegment || '; judge: ' || c_name || '; B' END AS labels, CASE c_custkey % 3 WHEN 2 THEN NULL ELSE c_name || ',second ' || c_nationkey END AS titles FROM customer""")
def labels_and_feed(t):
    """S-20, S-22: label and value cells, and the items of a feed (none where it declares entities)."""
    said = lambda *parts: F.concat(*[p if not isinstance(p, str) else F.lit(p) for p in parts])
    name, odd = F.col("c_name"), F.col("c_custkey") % 3 == 2
    page = F.when(odd, said("<p>", name, "</p>")).otherwise(said("<dl><dt>court</dt><dd>", F.col("c_mktsegment"), "</dd><dt>judge</dt><dd>", name, "</dd><dt>judge</dt> <dd><b>B</b></dd></dl>"))
    items = said("<rss><item><title>", name, "</title></item><item><title><![CDATA[second ", F.col("c_nationkey").cast("string"), "]]></title></item></rss>")
    rows = t.customer.select("c_custkey", page.alias("h"), F.when(odd, said("<!DOCTYPE x>", items)).otherwise(items).alias("x"))
    entries = F.transform(F.map_entries(html.labelled(F.col("h"))), lambda e: F.concat(e["key"], F.lit(": "), e["value"]))
    return rows.select("c_custkey", F.array_join(entries, "; ").alias("labels"), F.array_join(F.transform(html.feed_items(F.col("x")), lambda i: i["title"]), ",").alias("titles"))


@query("""WITH w AS (SELECT l_orderkey AS doc, CAST(l_linenumber % 2 AS INTEGER) AS page, l_linenumber * 1000000 + l_partkey AS seq, l_partkey % 100 AS x, l_suppkey % 4 AS y, l_returnflag || l_linestatus AS word FROM lineitem),
  l AS (SELECT doc, page, y, string_agg(word, ' ' ORDER BY x, seq) AS line FROM w GROUP BY 1, 2, 3) SELECT doc, page, CAST(row_number() OVER (PARTITION BY doc, page ORDER BY y) - 1 AS INTEGER) AS line_no, line FROM l""")
def words_to_lines(t):
    """X-15: words of a page, here lines of orders in four rows, as lines of text."""
    x, y = (F.col("l_partkey") % 100).cast("double"), (F.col("l_suppkey") % 4 * 10).cast("double")
    words = t.lineitem.select(F.col("l_orderkey").cast("long").alias("doc"), (F.col("l_linenumber") % 2).cast("int").alias("page"), (F.col("l_linenumber") * 1000000 + F.col("l_partkey")).alias("seq"), x.alias("x0"), y.alias("y0"), (x + 5).alias("x1"), (y + 8).alias("y1"), F.concat("l_returnflag", "l_linestatus").alias("word"))
    return layout.words_to_lines(words).select("doc", "page", "line_no", "line")


@query("""SELECT o_orderkey AS doc, CAST(i AS INTEGER) AS line_no, CASE WHEN i = 0 THEN 'A_TITLE_THAT_RUNS_ACROSS_BOTH_OF_THE_COLUMNS_OF_PAGE_' || o_orderkey WHEN i <= 8 THEN 'left ' || o_orderkey || ' ' || i ELSE 'right ' || o_custkey || ' ' || (i - 8) END AS line FROM orders, range(0, 17) t(i)""")
def column_order(t):
    """X-14, X-21: pages of two columns, one an order, in reading order."""
    i = F.col("line_no")
    left = F.rpad(F.concat(F.lit("left "), F.col("doc").cast("string"), F.lit(" "), i.cast("string")), 28, " ")
    text = F.when(i == 0, F.concat(F.lit("A_TITLE_THAT_RUNS_ACROSS_BOTH_OF_THE_COLUMNS_OF_PAGE_"), F.col("doc").cast("string"))).otherwise(F.concat(left, F.lit("right "), F.col("o_custkey").cast("string"), F.lit(" "), i.cast("string")))
    lines = t.orders.select(F.col("o_orderkey").cast("long").alias("doc"), "o_custkey", F.lit(1).alias("page"), F.explode(F.sequence(F.lit(0), F.lit(8))).alias("line_no"))
    return layout.column_order(lines.select("doc", "page", "line_no", text.alias("line"))).select("doc", "line_no", "line")


@query("""SELECT o_orderkey AS doc, 12 AS line_no, CAST(o_orderkey % 10 AS INTEGER) AS beside, 'note ' || o_custkey AS line FROM orders""")
def margin_notes(t):
    """X-16, A-07: notes in the margin, one on each order's page, with the line that they stand beside."""
    i = F.col("line_no")
    rows = t.orders.select(F.col("o_orderkey").cast("long").alias("doc"), "o_custkey", F.explode(F.sequence(F.lit(0), F.lit(12))).alias("line_no"))
    pick = lambda note, body: F.when(i == 12, note).otherwise(body)
    lines = rows.select(
        "doc", F.lit(1).alias("page"), "line_no", pick(F.lit(60.0), F.lit(0.0)).alias("x0"), pick(F.col("doc") % 10 * 10 + 2, i * 10).cast("double").alias("y0"), pick(F.lit(70.0), F.lit(50.0)).alias("x1"),
        pick(F.concat(F.lit("note "), F.col("o_custkey").cast("string")), F.concat(F.lit("body "), i.cast("string"))).alias("line"),
    )
    return layout.notes_to_body(layout.margin_notes(lines)).select("doc", "line_no", "beside", "line")


@query("""SELECT o_orderkey AS doc, (o_orderkey % 99 + 1) || ')' AS word, 1 AS seq FROM orders""")
def footnote_marks(t):
    """X-18: raised marks of notes, and none of the same size as the text."""
    word = lambda seq, x0, y0, x1, y1, said: F.struct(F.lit(seq).alias("seq"), *[F.lit(v).alias(n) for n, v in (("x0", x0), ("y0", y0), ("x1", x1), ("y1", y1))], said.alias("word"))
    mark = F.concat((F.col("o_orderkey") % 99 + 1).cast("string"), F.lit(")"))
    every = F.array(word(0, 0.0, 10.0, 9.0, 20.0, F.lit("ustawy")), word(1, 9.0, 9.0, 11.0, 15.0, mark), word(2, 12.0, 10.0, 14.0, 20.0, mark))
    words = t.orders.select(F.col("o_orderkey").alias("doc"), F.lit(1).alias("page"), F.explode(every).alias("w")).select("doc", "page", "w.*")
    return layout.footnote_marks(words).select("doc", "word", "seq")


@query("""SELECT o_orderkey AS doc, 0 AS first_line, CAST(3 + o_orderkey % 2 AS INTEGER) AS last_line, o_orderkey % 2 = 1 AS uncertain FROM orders""")
def uncertain_tables(t):
    """X-19, J-11: tables on the orders' pages; one whose row goes on left of a cell above it is uncertain."""
    cell = lambda *said: F.concat(*[F.rpad(x if not isinstance(x, str) else F.lit(x), 9, " ") for x in said])
    small = F.col("o_custkey").cast("string")
    plain = [cell("name", "from", "to"), cell("a", small, "2"), cell("b", "3", small), cell("c", "5", "6")]
    after = [F.lit(""), F.lit(""), F.lit(""), F.lit("text goes on")]
    lines = F.when(F.col("o_orderkey") % 2 == 1, F.array(*plain[:2], F.lit("       x        y"), *plain[2:], *after)).otherwise(F.array(*plain, *after))
    rows = t.orders.select(F.col("o_orderkey").cast("long").alias("doc"), F.lit(1).alias("page"), F.posexplode(lines).alias("line_no", "line"))
    return layout.uncertain_tables(rows).select("doc", "first_line", "last_line", "uncertain")


@query("""SELECT o_orderkey AS doc, '1:see ' || o_custkey || '|2:odnośnik 3|3:end' AS notes, CASE WHEN o_orderkey % 2 = 0 THEN '2,3' ELSE '1' END AS reached FROM orders""")
def footnote_closure(t):
    """X-06: the notes of each order's text, and those reached from one by its references."""
    said = F.concat(F.lit("1) see "), F.col("o_custkey").cast("string"), F.lit("\n2) odnośnik 3\n3) end\n2) again"))
    texts = t.orders.select(F.col("o_orderkey").alias("doc"), said.alias("text"))
    notes = passages.footnotes(passages.lines(texts, "doc", F.col("text")), "doc")
    reached = passages.note_closure(notes, "doc", texts.select("doc", F.when(F.col("doc") % 2 == 0, 2).otherwise(1).alias("note")))
    every = notes.groupBy("doc").agg(F.array_join(F.array_sort(F.collect_list(F.concat_ws(":", "note", "text"))), "|").alias("notes"))
    return every.join(reached.groupBy("doc").agg(F.array_join(F.transform(F.array_sort(F.collect_set("note")), lambda n: n.cast("string")), ",").alias("reached")), "doc")


@query("""SELECT o_orderkey, CAST(8 + length(o_custkey::VARCHAR) AS INTEGER) AS s, CAST(29 + length(o_custkey::VARCHAR) AS INTEGER) AS e FROM orders""")
def snapped_edges(t):
    """X-03: a span inside a sentence of each order's text, moved out to the sentence."""
    shift = F.char_length(F.col("o_custkey").cast("string")) + 1
    rows = t.orders.select("o_orderkey", F.concat(F.lit("First "), F.col("o_custkey").cast("string"), F.lit(". Second sentence here. Third.")).alias("t"), (shift + 14).alias("a"), (shift + 20).alias("b"))
    s = passages.snapped(F.col("t"), F.col("a"), F.col("b"))
    return rows.select("o_orderkey", s["s"].cast("int").alias("s"), s["e"].cast("int").alias("e"))


def queries() -> dict:
    def bind(f):
        return lambda spark, sf_dir: f(Tables(spark, sf_dir))

    return {name: bind(f) for name, (f, _) in QUERIES.items()}


def oracle_sql() -> dict:
    return {name: sql for name, (_, sql) in QUERIES.items()}


@query("""WITH t AS (SELECT o_custkey, o_orderstatus, o_orderpriority FROM orders) SELECT c.c_custkey, c.c_mktsegment AS segment, n.n_name AS nation, s.statuses, COALESCE(s.referred, 0) AS referred FROM customer c LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey LEFT JOIN (SELECT o_custkey, string_agg(DISTINCT o_orderstatus, '; ' ORDER BY o_orderstatus) AS statuses, count(*) AS referred FROM t GROUP BY 1) s ON s.o_custkey = c.c_custkey""")
def eav_record(t):
    """S-28: a record kept as (id, name, value) triples, read back as columns, with a label for an id and the number of reverse links."""
    own = t.customer.select(F.col("c_custkey").alias("id"), F.expr("stack(2, 'segment', c_mktsegment, 'nation', cast(c_nationkey as string)) as (name, value)"))
    said = t.orders.select(F.col("o_custkey").alias("id"), F.lit("status").alias("name"), F.col("o_orderstatus").alias("value"))
    records = versions.record_of_values(own.unionByName(said.join(own.select("id").distinct(), "id", "left_semi")), "id")
    links = t.orders.groupBy(F.col("o_custkey").alias("id")).agg(F.count("*").alias("referred"))
    rows = records.join(links, "id", "left").withColumn("n_nationkey", F.col("record")["nation"].cast("int")).join(t.nation.select(F.col("n_nationkey").cast("int"), "n_name"), "n_nationkey", "left")
    return rows.select(F.col("id").alias("c_custkey"), F.col("record")["segment"].alias("segment"), F.col("n_name").alias("nation"), F.col("record")["status"].alias("statuses"), F.coalesce("referred", F.lit(0)).alias("referred"))


@query("""SELECT o_orderkey, o_custkey, CAST(row_number() OVER (PARTITION BY o_orderkey ORDER BY l_linenumber, l_suppkey) - 1 AS INTEGER) AS place, l_suppkey AS party, CASE WHEN row_number() OVER (PARTITION BY o_orderkey ORDER BY l_linenumber, l_suppkey) = 1 THEN 'buyer' ELSE 'other' END AS role FROM orders JOIN lineitem ON l_orderkey = o_orderkey""")
def contract_record(t):
    """S-30: a contract with its parties in one array, spelled out to a row for each party with its place and role."""
    parties = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_suppkey"))).alias("parties"))
    rows = t.orders.select("o_orderkey", "o_custkey").join(parties, "o_orderkey").select("o_orderkey", "o_custkey", F.posexplode("parties").alias("place", "p"))
    return rows.select("o_orderkey", "o_custkey", "place", F.col("p.l_suppkey").alias("party"), F.when(F.col("place") == 0, "buyer").otherwise("other").alias("role"))


@query("""WITH f AS (SELECT r AS round, c_custkey AS id FROM customer, range(1, 9) t(r) WHERE (c_custkey * 7 + r * 3) % 5 < 2 AND r <= 5 OR r > 5 AND c_custkey % 5 = 0), g AS (SELECT id, min(round) AS round FROM f GROUP BY 1), n AS (SELECT r.round, count(g.id) AS new FROM (SELECT DISTINCT round FROM f) r LEFT JOIN g USING (round) GROUP BY 1), s AS (SELECT round, new, CAST(sum(new) OVER (ORDER BY round) AS BIGINT) AS seen, sum(new) OVER (ORDER BY round ROWS BETWEEN 1 PRECEDING AND CURRENT ROW) AS late, row_number() OVER (ORDER BY round) AS nth FROM n), v AS (SELECT *, CASE WHEN seen >= (SELECT count(*) FROM customer) THEN 'COMPLETE' WHEN late = 0 AND nth >= 2 THEN 'STALLED' ELSE 'MORE' END AS state FROM s) SELECT round, new, seen, state FROM v WHERE NOT EXISTS (SELECT 1 FROM v p WHERE p.round < v.round AND p.state <> 'MORE')""")
def paging_rounds(t):
    """L-05: rounds over a source that shows two fifths of its rows each time, united by id until they are complete."""
    rounds = t.customer.select(F.col("c_custkey").alias("id"), F.explode(F.sequence(F.lit(1), F.lit(8))).alias("round"))
    rounds = rounds.withColumn("round", F.col("round").cast("long"))
    found = rounds.where("((id * 7 + round * 3) % 5 < 2 and round <= 5) or (round > 5 and id % 5 = 0)")
    return search.complete_paging(found, t.customer.count())


@query("""WITH c AS (SELECT l_orderkey AS act, CASE WHEN l_linenumber % 4 = 0 THEN NULL ELSE l_partkey % 10 END AS article, l_suppkey AS amendment, l_returnflag AS flag FROM lineitem), k AS (SELECT DISTINCT act, amendment FROM c WHERE flag = 'R'), l AS (SELECT c.* FROM c WHERE NOT EXISTS (SELECT 1 FROM k WHERE k.act = c.act AND k.amendment = c.amendment)), q AS (SELECT o_orderkey AS act, a AS article FROM orders, range(0, 10) t(a) WHERE (o_orderkey + a) % 7 = 0), n AS (SELECT act, article, count(DISTINCT amendment) AS amendments FROM l WHERE article IS NOT NULL GROUP BY 1, 2) SELECT q.act, q.article, CASE WHEN n.amendments > 0 THEN 'CHANGED' WHEN EXISTS (SELECT 1 FROM l WHERE l.act = q.act AND l.article IS NULL) OR o.o_orderstatus = 'P' THEN 'UNSURE' ELSE 'CURRENT' END AS verdict, COALESCE(n.amendments, 0) AS amendments FROM q JOIN orders o ON o.o_orderkey = q.act LEFT JOIN n ON n.act = q.act AND n.article = q.article""")
def article_currency(t):
    """V-02: articles asked for, against changes that the text does not contain yet; an act that was not checked to the day is never called current."""
    changes = t.lineitem.select(F.col("l_orderkey").cast("long").alias("act"), F.when(F.col("l_linenumber") % 4 != 0, F.col("l_partkey") % 10).cast("long").alias("article"), F.col("l_suppkey").alias("amendment"), "l_returnflag")
    contained = changes.where("l_returnflag = 'R'").select("act", "amendment").distinct()
    asked = t.orders.select(F.col("o_orderkey").cast("long").alias("act"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(9).cast("long"))).alias("article")).where("(act + article) % 7 = 0")
    checked = t.orders.where("o_orderstatus != 'P'").select(F.col("o_orderkey").cast("long").alias("act"))
    return versions.article_currency(asked, changes.drop("l_returnflag"), contained, checked)


@query("""SELECT o_orderstatus AS status, CAST(year(o_orderdate) AS INTEGER) AS made, count(*) AS n FROM orders GROUP BY GROUPING SETS ((o_orderstatus, year(o_orderdate)), (o_orderstatus), ())""")
def grouping_sets(t):
    """§2.12: counts by status and year, by status, and over all, in one aggregation."""
    return t.spark.sql("SELECT o_orderstatus AS status, CAST(year(o_orderdate) AS INT) AS made, count(*) AS n FROM {o} GROUP BY GROUPING SETS ((o_orderstatus, year(o_orderdate)), (o_orderstatus), ())", o=t.orders)


@query("""SELECT c_mktsegment AS segment, count(*) FILTER (c_nationkey % 2 = 0) AS even, count(*) FILTER (c_nationkey % 2 = 1) AS odd FROM customer GROUP BY 1""")
def pivoted_counts(t):
    """§2.12: a pivot over a fixed list of values, which needs no extra pass to find them."""
    side = F.when(F.col("c_nationkey") % 2 == 0, "even").otherwise("odd")
    return t.customer.select(F.col("c_mktsegment").alias("segment"), side.alias("side")).groupBy("segment").pivot("side", ["even", "odd"]).count().na.fill(0)


@query("""WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS n FROM documents),
  p AS (SELECT *, last_value(CASE WHEN length(line) BETWEEN 1 AND 40 THEN length(line) % 4 END IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS act FROM l)
  SELECT doc_id, CAST(n AS INTEGER) AS line_no, line FROM p WHERE act = 2""")
def act_of_issue(t):
    """X-20: the lines of one act of an issue; a short line opens an act and its length gives the position."""
    position = F.when(F.char_length("line").between(1, 40), F.char_length("line") % 4)
    return passages.act_of_issue(passages.lines(t.documents, "doc_id", F.col("text")), "doc_id", position, 2).select("doc_id", "line_no", "line")


@query("""SELECT DISTINCT p_name, lower(p_name) = 'small g' AS exists FROM part WHERE starts_with(lower(p_name), 'small') AND contains(lower(p_name), 'g') ORDER BY exists DESC, p_name LIMIT 12""")
def keyword_scan(t):
    """S-18: dictionary entries that begin like a keyword and hold its other words."""
    return search.keyword_scan(t.part, "p_name", "small g")
