"""Queries on structures that tables hold: trees of units, graphs of triples, pages that arrive in rounds, saved searches."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import graphs, paging, saved, trees
from .tables import query

_UNITS = """WITH RECURSIVE units AS (SELECT 'r' || r_regionkey AS id, NULL AS parent, r_name AS name FROM region UNION ALL SELECT 'n' || n_nationkey, 'r' || n_regionkey, n_name FROM nation
  UNION ALL SELECT 's' || s_suppkey, 'n' || s_nationkey, s_name FROM supplier UNION ALL SELECT 'c' || c_custkey, 's' || (c_custkey % 7), c_name FROM customer),
  tree AS (SELECT id, name, 0 AS depth, [id] AS path FROM units WHERE parent IS NULL UNION ALL SELECT u.id, u.name, t.depth + 1, list_append(t.path, u.id) FROM units u JOIN tree t ON u.parent = t.id)"""


def _units(t) -> DataFrame:
    """Regions, their nations, their suppliers, and customers below the first suppliers."""
    key = lambda p, c: F.concat(F.lit(p), F.col(c).cast("string"))
    of = lambda df, p, c, up, name: df.select(key(p, c).alias("id"), up.alias("parent"), F.col(name).alias("name"))
    return (
        of(t.region, "r", "r_regionkey", F.lit(None).cast("string"), "r_name").unionByName(of(t.nation, "n", "n_nationkey", key("r", "n_regionkey"), "n_name"))
        .unionByName(of(t.supplier, "s", "s_suppkey", key("n", "s_nationkey"), "s_name"))
        .unionByName(of(t.customer, "c", "c_custkey", F.concat(F.lit("s"), (F.col("c_custkey") % 7).cast("string")), "c_name"))
    )


@query(_UNITS + """, p AS (SELECT *, row_number() OVER (PARTITION BY path[1] ORDER BY path) AS l FROM tree)
  SELECT a.id, CAST(a.depth AS INTEGER) AS depth, a.l AS "left", a.l + coalesce(n, 0) AS "right" FROM p a LEFT JOIN (SELECT up, count(*) AS n FROM (SELECT unnest(path[:-2]) AS up FROM tree) GROUP BY 1) d ON d.up = a.id""")
def unit_tree(t):
    """S-08: the units of a tree of any depth, numbered so that what is below a unit is a range."""
    return trees.nested_intervals(_units(t), "id", "parent").select("id", "depth", "left", "right")


@query(_UNITS + """, h AS (SELECT DISTINCT unnest(path) AS id FROM tree WHERE contains(name, '17') AND depth <= 2)
  SELECT t.id, CAST(t.depth AS INTEGER) AS depth, contains(t.name, '17') AS hit FROM tree t JOIN h ON h.id = t.id WHERE t.depth <= 2""")
def unit_tree_search(t):
    """S-08: the units whose text holds a phrase, with the units above them, down to a depth."""
    tree = trees.nested_intervals(_units(t), "id", "parent").where("depth <= 2")
    return trees.filtered(tree, F.contains("name", F.lit("17")), depth=2).select("id", "depth", "hit")


@query(_UNITS + """ SELECT t.id, contains(t.name, 'NATION_1') AS hit FROM tree t WHERE list_has_any(t.path, (SELECT list(id) FROM tree WHERE contains(name, 'NATION_1')))
  OR t.id IN (SELECT unnest(path) FROM tree WHERE contains(name, 'NATION_1'))""")
def unit_tree_below(t):
    """S-08: hits of a text filter with everything above and below them."""
    tree = trees.nested_intervals(_units(t), "id", "parent")
    return trees.filtered(tree, F.contains("name", F.lit("NATION_1")), below=True).select("id", "hit")


@query("""SELECT DISTINCT 'c' || c_custkey AS c, 'n' || n_nationkey AS n FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  WHERE o_orderstatus = 'F' AND n_regionkey = 1 AND c_mktsegment = 'BUILDING'""")
def graph_pattern(t):
    """S-12: five patterns over one table of triples of customers, orders and nations; repeats of orders never multiply."""
    key = lambda p, c: F.concat(F.lit(p), F.col(c).cast("string"))
    said = lambda df, s, *facts: df.select(s.alias("s"), F.explode(F.array(*[F.struct(F.lit(p).alias("p"), o.alias("o")) for p, o in facts])).alias("f")).select("s", "f.p", "f.o")
    triples = (
        said(t.customer, key("c", "c_custkey"), ("segment", F.col("c_mktsegment")), ("nation", key("n", "c_nationkey")))
        .unionByName(said(t.orders, key("o", "o_orderkey"), ("of", key("c", "o_custkey")), ("status", F.col("o_orderstatus")), ("priority", F.col("o_orderpriority"))))
        .unionByName(said(t.nation, key("n", "n_nationkey"), ("region", key("r", "n_regionkey")), ("name", F.col("n_name"))))
    )
    patterns = [("?o", "of", "?c"), ("?o", "status", "F"), ("?c", "nation", "?n"), ("?n", "region", "r1"), ("?c", "segment", "BUILDING")]
    return graphs.match(triples, patterns, ["c", "n"])


@query("""WITH RECURSIVE a AS (SELECT user_id, CAST(day(ts) AS BIGINT) AS round, CAST(20 + day(ts) // 3 AS BIGINT) AS total, CAST(event_id % 25 AS VARCHAR) AS id, row_number() OVER (PARTITION BY user_id ORDER BY day(ts), event_id) AS i FROM events),
  f AS (SELECT user_id, CAST(0 AS BIGINT) AS i, CAST(NULL AS BIGINT) AS round, CAST(0 AS BIGINT) AS pages, CAST(NULL AS BIGINT) AS total, CAST([] AS VARCHAR[]) AS seen, CAST(0 AS BIGINT) AS new, CAST(0 AS BIGINT) AS restarts, FALSE AS dropped, CAST(0 AS BIGINT) AS stall, 'MORE' AS state
    FROM (SELECT DISTINCT user_id FROM events)
    UNION ALL SELECT user_id, i + 1, CASE WHEN stopped THEN round ELSE round2 END, CASE WHEN stopped THEN pages ELSE pages + 1 END, CASE WHEN stopped THEN total WHEN beyond THEN NULL ELSE total2 END,
      CASE WHEN stopped THEN seen WHEN beyond THEN CAST([] AS VARCHAR[]) ELSE next END, CASE WHEN stopped THEN new WHEN beyond THEN 0 ELSE new1 + len(next) - len(base) END,
      CASE WHEN stopped THEN restarts ELSE restarts + CASE WHEN changed THEN 1 ELSE 0 END + CASE WHEN beyond THEN 1 ELSE 0 END END, CASE WHEN stopped THEN dropped ELSE dropped1 OR beyond END, stall1,
      CASE WHEN stopped THEN 'STALLED' WHEN NOT beyond AND len(next) = total2 THEN 'COMPLETE' WHEN pages + 1 >= 60 THEN 'BUDGET' ELSE 'MORE' END
    FROM (SELECT *, len(next) > total2 AS beyond FROM (SELECT *, CASE WHEN list_contains(base, id) THEN base ELSE list_append(base, id) END AS next FROM (
      SELECT *, CASE WHEN changed THEN CAST([] AS VARCHAR[]) ELSE seen END AS base, CASE WHEN changed OR turned THEN 0 ELSE new END AS new1, changed OR (dropped AND NOT turned) AS dropped1, stall1 >= 3 AND turned AND round IS NOT NULL AS stopped FROM (
        SELECT f.*, a.round AS round2, a.total AS total2, a.id AS id, f.round IS DISTINCT FROM a.round AS turned, coalesce(f.total <> a.total, FALSE) AS changed,
          CASE WHEN f.round <> a.round THEN CASE WHEN f.new > 0 AND NOT f.dropped THEN 0 ELSE f.stall + 1 END ELSE f.stall END AS stall1 FROM f JOIN a ON a.user_id = f.user_id AND a.i = f.i + 1 WHERE f.state = 'MORE'))))),
  e AS (SELECT user_id, unnest(max_by(struct_pack(round, pages, total, seen, new, restarts, dropped, stall, state), i)) FROM f GROUP BY user_id)
  SELECT user_id, round, pages, total, CAST(len(seen) AS BIGINT) AS seen, restarts, CASE WHEN state = 'MORE' AND NOT (new > 0 AND NOT dropped) AND stall + 1 >= 3 THEN 'STALLED' ELSE state END AS state FROM e""")
def paging_restarts(t):
    """L-05: pages of a list that arrive in rounds, folded with state: ids are collected until they are as many as announced, and dropped when the announced
    total changes or is exceeded; rounds without progress and spent pages end it. Every event is a page with one id."""
    page = t.events.select("user_id", F.dayofmonth("ts").alias("round"), F.col("event_id").alias("page"), F.floor(20 + F.dayofmonth("ts") / 3).alias("total"), F.array((F.col("event_id") % 25).cast("string")).alias("ids"))
    return paging.paged(page, "user_id")


#: Sort keys as data: field of the record's own section and whether it is a number.
SORTS = (("orderkey", True), ("custkey", True), ("status", False), ("totalprice", True), ("orderdate", False), ("priority", False), ("lines", True), ("quantity", True), ("cost", True), ("first", False), ("last", False))
_VALUE = {"orderkey": "o_orderkey", "custkey": "o_custkey", "status": "o_orderstatus", "totalprice": "o_totalprice", "orderdate": "o_orderdate", "priority": "o_orderpriority"}
_ORDER_BY = ", ".join(
    f"CASE WHEN s_suppkey % 22 = {2 * i + d} THEN {_VALUE.get(field, field)} END {'DESC' if d else 'ASC'} NULLS LAST" for i, (field, _) in enumerate(SORTS) for d in (0, 1)
)


@query(f"""WITH l AS (SELECT l_orderkey, count(*) AS lines, sum(CAST(l_quantity AS BIGINT)) AS quantity, max(l_extendedprice) AS cost, min(l_shipdate) AS first, max(l_shipdate) AS last FROM lineitem GROUP BY 1),
  h AS (SELECT DISTINCT s_suppkey, l_orderkey FROM supplier JOIN lineitem ON l_suppkey = s_suppkey WHERE l_quantity >= 10 + s_suppkey % 30 AND (s_suppkey % 2 = 1 OR l_returnflag IN ('A', 'R'))),
  m AS (SELECT s_suppkey, o.*, l.* EXCLUDE (l_orderkey) FROM h JOIN orders o ON o.o_orderkey = h.l_orderkey JOIN l ON l.l_orderkey = h.l_orderkey
    WHERE o_orderstatus IN ('F', 'O') AND o_totalprice <= 100000 + 1000 * (s_suppkey % 100) AND (s_suppkey % 3 <> 0 OR o_orderdate >= TIMESTAMP '1995-01-01'))
  SELECT search, total, rank, doc FROM (SELECT CAST(s_suppkey AS BIGINT) AS search, count(*) OVER (PARTITION BY s_suppkey) AS total, CAST(row_number() OVER (PARTITION BY s_suppkey ORDER BY {_ORDER_BY}, o_orderkey) AS INTEGER) AS rank, CAST(o_orderkey AS BIGINT) AS doc FROM m) WHERE rank <= 5""")
def saved_searches(t):
    """S-05, S-16, S-25, S-27, S-29, L-01: a search for each supplier with criteria on orders and on one and the same line of theirs, each with one of 22
    sort keys; all in one job."""
    day = lambda c: F.date_format(c, "yyyy-MM-dd")
    fields = lambda **kw: F.map_from_arrays(F.array(*[F.lit(k) for k in kw]), F.array(*[v.cast("string") for v in kw.values()]))
    lines = t.lineitem.groupBy("l_orderkey").agg(
        F.count("*").alias("lines"), F.sum(F.col("l_quantity").cast("long")).alias("quantity"), F.max("l_extendedprice").alias("cost"), F.min("l_shipdate").alias("first"), F.max("l_shipdate").alias("last")
    )
    orders = t.orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    own = fields(orderkey=F.col("o_orderkey"), custkey=F.col("o_custkey"), status=F.col("o_orderstatus"), totalprice=F.col("o_totalprice"), orderdate=day("o_orderdate"), priority=F.col("o_orderpriority"),
                 lines=F.col("lines"), quantity=F.col("quantity"), cost=F.col("cost"), first=day("first"), last=day("last"))
    line = fields(suppkey=F.col("l_suppkey"), quantity=F.col("l_quantity"), returnflag=F.col("l_returnflag"))
    records = orders.select(F.col("o_orderkey").cast("long").alias("doc"), F.lit("order").alias("section"), own.alias("fields"))
    records = records.unionByName(t.lineitem.select(F.col("l_orderkey").cast("long").alias("doc"), F.lit("line").alias("section"), line.alias("fields")))
    s = F.col("s_suppkey")
    criterion = lambda section, field, op, value: F.struct(F.lit(section).alias("section"), F.lit(field).alias("field"), F.lit(op).alias("op"), value.cast("string").alias("value"))
    some = lambda c, v: F.when(c, F.lit(v))
    criteria = F.array(
        criterion("line", "suppkey", "eq", s), criterion("line", "quantity", "ge", 10 + s % 30), criterion("line", "returnflag", "eq", some(s % 2 == 0, "A")), criterion("line", "returnflag", "eq", some(s % 2 == 0, "R")),
        criterion("order", "status", "eq", F.lit("F")), criterion("order", "status", "eq", F.lit("O")), criterion("order", "totalprice", "le", 100000 + 1000 * (s % 100)), criterion("order", "orderdate", "from", some(s % 3 == 0, "1995-01-01")),
    )
    searches = t.supplier.select(s.cast("long").alias("search"), F.explode(criteria).alias("c")).select("search", "c.*")
    sort = F.array(*[F.struct(F.lit("order").alias("section"), F.lit(field).alias("field"), F.lit(numeric).alias("numeric"), F.lit(bool(down)).alias("descending")) for field, numeric in SORTS for down in (0, 1)])
    keys = t.supplier.select(s.cast("long").alias("search"), F.get(sort, (s % 22).cast("int")).alias("k")).select("search", "k.*")
    return saved.first_pages(saved.matches(records, searches), keys, 5)
