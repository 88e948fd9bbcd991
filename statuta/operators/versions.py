"""Versions and relations of acts: which text is in force, what later changes it does not hold, who refers to whom."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_not_future(rows: DataFrame, key: str, when: str, today, tie: str) -> DataFrame:
    """F-10: for each key the newest row that is not in the future. One pre-aggregated maximum, no sort."""
    best = rows.where(F.col(when) <= F.lit(today)).groupBy(key).agg(F.max(F.struct(when, tie)).alias("_m"))
    return best.select(key, f"_m.{when}", f"_m.{tie}")


def future_versions(rows: DataFrame, when: str, today) -> DataFrame:
    return rows.where(F.col(when) > F.lit(today))


def newer_of_same_base(rows: DataFrame, base: str, order: list[str]) -> DataFrame:
    """J-01: each row with the newest row of its base if that is newer than itself: columns newest_<order>."""
    newest = rows.groupBy(base).agg(F.max(F.struct(*order)).alias("_n")).select(F.col(base).alias("_b"), *[F.col(f"_n.{c}").alias(f"newest_{c}") for c in order])
    return rows.join(newest, F.col(base) == F.col("_b")).where(F.struct(*order) < F.struct(*[F.col(f"newest_{c}").alias(c) for c in order])).drop("_b")


def merged_lists(own: DataFrame, base: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """J-02: full outer union of two lists of changes; the own list's values first."""
    both = own.select(key, *[F.col(c).alias(f"_a_{c}") for c in columns], F.lit(True).alias("_a")).join(base.select(key, *[F.col(c).alias(f"_b_{c}") for c in columns], F.lit(True).alias("_b")), key, "full_outer")
    return both.select(key, *[F.coalesce(f"_a_{c}", f"_b_{c}").alias(c) for c in columns], F.when(F.col("_a") & F.col("_b"), "both").when(F.col("_a"), "own").otherwise("base").alias("listed"))


def not_contained(changes: DataFrame, listed: DataFrame, on: list[str], version: str) -> DataFrame:
    """J-04: changes that neither this version nor an earlier one lists. The equi-keys carry the join, the version is a residual condition."""
    other = listed.select(*[F.col(c).alias(f"_l_{c}") for c in [*on, version]])
    condition = F.col(f"_l_{version}") <= F.col(version)
    for c in on:
        condition = condition & (F.col(c) == F.col(f"_l_{c}"))
    return changes.join(other, condition, "left_anti")


def unique_match(left: DataFrame, right: DataFrame, on: list[str], key: str) -> DataFrame:
    """J-09: left with the key of its matches in right, only where it is a single one."""
    one = right.groupBy(*on).agg(F.min(key).alias(key), F.max(key).alias("_m")).where(F.col(key) == F.col("_m")).drop("_m")
    return left.join(one, on)


def enclosing(rows: DataFrame, doc: str, position: str, heading: Column, name: str) -> DataFrame:
    """J-10: each row with the nearest heading at or before it in its document."""
    w = Window.partitionBy(doc).orderBy(position).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return rows.withColumn(name, F.last(heading, ignorenulls=True).over(w))


def overlapping(a: DataFrame, b: DataFrame, doc: str, width: int) -> DataFrame:
    """J-11: pairs of spans [s, e) of one document that overlap. Spans are dealt to all cells of `width` they touch, so the join is an
    equi-join on (document, cell); a pair counts in the cell where the later of the two begins."""
    cells = lambda d, s, e: F.explode(F.sequence(F.floor(F.col(s) / width), F.floor((F.col(e) - 1) / width)))
    left, right = a.where("s < e").withColumn("cell", cells(a, "s", "e")), b.where("s < e").select(doc, F.col("s").alias("s2"), F.col("e").alias("e2"), *[c for c in b.columns if c not in (doc, "s", "e")]).withColumn("cell", cells(b, "s2", "e2"))
    return left.join(right, [doc, "cell"]).where("s < e2 and s2 < e").where(F.col("cell") == F.floor(F.greatest("s", "s2") / width)).drop("cell")


def relations_by_kind(edges: DataFrame, src: str, kind: str, dst: str) -> DataFrame:
    """A-01, U-01: distinct neighbours of each node by kind: how many, and the first twenty in order."""
    distinct = edges.select(src, kind, dst).distinct()
    rank = F.row_number().over(Window.partitionBy(src, kind).orderBy(dst))
    return distinct.withColumn("r", rank).groupBy(src, kind).agg(F.count("*").alias("n"), F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col("r") <= 20, F.struct("r", dst)))), lambda x: x[dst].cast("string")), ",").alias("first"))


def depth_tree(nodes: DataFrame, node: str, parent: str, levels: int) -> DataFrame:
    """S-08: depth of each node below the roots (null parent), for at most `levels` levels: one equi-join a level."""
    level = nodes.where(F.col(parent).isNull()).select(F.col(node), F.lit(0).alias("depth"), F.col(node).cast("string").alias("path"))
    out = level
    for d in range(1, levels + 1):
        up = level.select(F.col(node).alias("_p"), F.col("path").alias("_path"))
        level = nodes.join(up, F.col(parent) == F.col("_p")).select(F.col(node), F.lit(d).alias("depth"), F.concat_ws("/", "_path", F.col(node).cast("string")).alias("path"))
        out = out.unionByName(level)
    return out


def article_currency(asked: DataFrame, changes: DataFrame, contained: DataFrame, checked: DataFrame) -> DataFrame:
    """V-02: asked (act, article) against changes (act, article or null for an unnamed one, amendment), less those contained (act, amendment) in the text.

    (act, article, verdict, amendments): CHANGED by an amendment that names the article, UNSURE if one may concern it or the act is not
    among the checked (act), else CURRENT; amendments: how many were not contained and name the article.
    """
    later = changes.join(contained, ["act", "amendment"], "left_anti")
    named = later.where("article is not null").groupBy("act", "article").agg(F.count_distinct("amendment").alias("amendments"))
    vague = later.where("article is null").select("act").distinct().withColumn("vague", F.lit(True))
    known = checked.select("act").distinct().withColumn("known", F.lit(True))
    out = asked.join(named, ["act", "article"], "left").join(vague, "act", "left").join(known, "act", "left")
    verdict = F.when(F.col("amendments") > 0, "CHANGED").when(F.coalesce("vague", F.lit(False)) | F.col("known").isNull(), "UNSURE").otherwise("CURRENT")
    return out.select("act", "article", verdict.alias("verdict"), F.coalesce("amendments", F.lit(0)).cast("long").alias("amendments"))


def record_of_values(triples: DataFrame, key: str) -> DataFrame:
    """S-28: (key, name, value) triples of records as one map a record; repeated values of a name are joined in order."""
    per = triples.groupBy(key, "name").agg(F.array_join(F.array_sort(F.collect_set("value")), "; ").alias("value"))
    return per.groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct("name", "value"))).alias("record"))
