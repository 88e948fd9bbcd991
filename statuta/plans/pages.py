"""Queries over pages as node tables, each with the SQL that says the same."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..sources import nodes, tables
from .tables import query

# what a piece of a page says: tags are spaces, entities are read, white space is folded
_ENTITIES = (("&nbsp;", "chr(160)"), ("&lt;", "'<'"), ("&gt;", "'>'"), ("&quot;", "'\"'"), ("&#39;", "''''"), ("&copy;", "'©'"), ("&middot;", "'·'"), ("&amp;", "'&'"))


def _said(piece: str) -> str:
    out = f"regexp_replace({piece}, '<[^>]*>', ' ', 'g')"
    for entity, char in _ENTITIES:
        out = f"replace({out}, '{entity}', {char})"
    return rf"trim(regexp_replace({out}, '[\s' || chr(160) || ']+', ' ', 'g'))"


_PARAGRAPHS = "string_split(split_part(split_part(html, '<article>', 2), '</article>', 1), '<p>')[2:]"


@query("""SELECT page_id, tag, parent, n FROM (SELECT page_id, unnest(['a', 'li', 'p', 'h1', 'footer', 'b']) AS tag, unnest(['li', 'ul', 'article', 'article', 'body', 'p']) AS parent,
  unnest([len(regexp_extract_all(html, '<a ')), len(regexp_extract_all(html, '<li>')), len(regexp_extract_all(html, '<p>')), len(regexp_extract_all(html, '<h1>')), len(regexp_extract_all(html, '<footer>')), len(regexp_extract_all(html, '<b>'))]) AS n FROM pages) WHERE n > 0""")
def page_nodes(t):
    """S-19, S-24: how often each tag stands under each other, paragraphs that nothing closes among them."""
    rows = nodes.node_table(t.pages, "page_id").select("page_id", "node", "parent", "tag")
    above = rows.select("page_id", F.col("node").alias("parent"), F.col("tag").alias("over"))
    counted = rows.where(F.col("tag").isin("a", "li", "p", "h1", "footer", "b")).join(above, ["page_id", "parent"])
    return counted.groupBy("page_id", "tag", F.col("over").alias("parent")).agg(F.count("*").alias("n"))


@query(f"""WITH p AS (SELECT page_id, {_said("split_part(split_part(html, '<h1>', 2), '</h1>', 1)")} AS title, {_PARAGRAPHS} AS l FROM pages)
  SELECT page_id, 0 AS place, title AS text FROM p UNION ALL SELECT page_id, CAST(i AS INTEGER), {_said('x')} FROM (SELECT page_id, unnest(l) AS x, generate_subscripts(l, 1) AS i FROM p)""")
def page_hits(t):
    """S-19, S-23: each hit of a page (its heading) with the related rows below it (paragraphs), in order."""
    rows = nodes.related_hits(nodes.node_table(t.pages, "page_id"), "page_id", F.col("tag") == "h1", F.col("tag") == "p")
    return rows.select("page_id", "place", F.coalesce("text", F.lit("")).alias("text"))


@query("""SELECT page_id, announced, rows, CASE WHEN announced = rows THEN 'COMPLETE' ELSE 'UNKNOWN' END AS status FROM (SELECT page_id, TRY_CAST(regexp_extract(url, '/(\\d+)(\\?|$)', 1) AS BIGINT) AS announced, len(regexp_extract_all(split_part(html, '</nav>', 1), '<a ')) AS rows FROM pages)""")
def page_announced(t):
    """S-19, S-10: the number that a page announces (here the one in its address) against the rows of its list."""
    listed = nodes.node_table(t.pages, "page_id").where("tag in ('a', 'nav')")
    end = F.max(F.when(F.col("tag") == "nav", F.col("last"))).over(nodes.Window.partitionBy("page_id"))
    found = listed.withColumn("end", end).where("tag = 'a' and node <= end")
    announced = t.pages.select("page_id", F.regexp_extract("url", r"/(\d+)(\?|$)", 1).try_cast("long").alias("total"))
    return tables.complete(found, announced, "page_id").select("page_id", F.col("total").alias("announced"), F.col("fetched").alias("rows"), "status")


@query(f"""SELECT page_id, {_said("split_part(split_part(html, '<div class=\"ad\">', 2), '</div>', 1)")} AS label, {_said("split_part(split_part(html, '<footer>', 2), '</footer>', 1)")} AS value FROM pages""")
def page_pairs(t):
    """S-20, S-24: label cells with the value cells that follow them under the same parent."""
    rows = nodes.node_table(t.pages, "page_id")
    return nodes.label_pairs(rows, "page_id", (F.col("tag") == "div") & (F.col("class") == "ad"), F.col("tag") == "footer")


@query(f"""SELECT page_id, {_said("split_part(split_part(html, '<h1>', 2), '</h1>', 1)")} AS heading, {_said("html[strpos(html, '</h1>'):]")} AS text FROM pages""")
def page_sections(t):
    """S-24: what stands under each heading of a page."""
    return nodes.sections(nodes.node_table(t.pages, "page_id"), "page_id", F.col("tag") == "h1").select("page_id", "heading", "text")
