"""Searches: criteria, resolution of names, order, pages and verdicts. All are DataFrame -> DataFrame without actions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

FOUND, ABSENT, UNKNOWN = "FOUND", "VERIFIED_ABSENT", "UNKNOWN"


def meets(*criteria: Column | None) -> Column:
    """F-01: all given criteria; at least one must be given."""
    given = [c for c in criteria if c is not None]
    if not given:
        raise ValueError("give at least one criterion")
    return reduce(lambda a, b: a & b, given)


def between(value: Column, low=None, high=None) -> Column | None:
    """F-05, F-06: inclusive range, open where an end is not given; no criterion without ends."""
    ends = [value >= F.lit(low) if low is not None else None, value <= F.lit(high) if high is not None else None]
    return meets(*ends) if any(e is not None for e in ends) else None


def page(df: DataFrame, order: list[Column], number: int, size: int) -> DataFrame:
    """L-04: page `number` (from 1) of the filtered list; pages 1, 2, ... cover it exactly when order ends in a unique key.

    Offset and limit push a bounded top-k to the tasks; nothing is ranked globally.
    """
    return df.orderBy(*order).offset((number - 1) * size).limit(size)


def ranked_page(df: DataFrame, order: list[Column], number: int, size: int) -> DataFrame:
    """L-04 with the row's number in the list: the bounded page gets its numbers from its place."""
    rank = F.row_number().over(Window.orderBy(*order)) + (number - 1) * size
    return page(df, order, number, size).withColumn("rank", rank)


def page_status(total: Column, number: Column, size: Column, rows: Column, window: int = 10_000) -> Column:
    """L-06: why a page is empty."""
    return (
        F.when(rows > 0, "OK").when(total == 0, ABSENT)
        .when(((number * size) >= window) & (total > window), "WINDOW_EXHAUSTED")
        .when((number - 1) * size >= total, "BEYOND_END").otherwise("SERVER_FAULT")
    )


def resolve_prefix(asked: DataFrame, dictionary: DataFrame) -> DataFrame:
    """F-09: asked (q) against dictionary (name): 'one' with the name, 'none' or 'many'. An exact name wins.

    Names are spelled out to their prefixes and counted by prefix, so the join is on equality.
    """
    low = F.lower("name")
    prefixes = dictionary.select("name", F.explode(F.transform(F.sequence(F.lit(0), F.char_length(low)), lambda n: F.left(low, n))).alias("p"))
    counted = prefixes.groupBy("p").agg(F.count("name").alias("n"), F.max(F.when(low == F.col("p"), F.col("name"))).alias("exact"), F.min("name").alias("first"))
    n = asked.select("q").distinct().withColumn("p", F.lower("q")).join(counted, "p", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    return n.select("q", F.when(F.col("exact").isNotNull() | (F.col("n") == 1), "one").when(F.col("n") == 0, "none").otherwise("many").alias("outcome"), F.coalesce("exact", F.when(F.col("n") == 1, F.col("first"))).alias("name"))


def exact_else_fragment(rows: DataFrame, column: str, wanted: str) -> DataFrame:
    """F-13: rows that contain the text, marked exact or partial; partial ones only where no row is exact."""
    low, w = F.lower(column), F.lit(wanted.lower())
    hits = rows.where(F.contains(low, w)).withColumn("match", F.when(low == w, "exact").otherwise("partial"))
    some = rows.where(low == w).limit(1).select(F.lit(True).alias("_exact"))
    return hits.join(some, F.lit(True), "left").where((F.col("match") == "exact") | F.col("_exact").isNull()).drop("_exact")


def with_aliases(rows: DataFrame, column: str, aliases: DataFrame) -> DataFrame:
    """F-08: rows whose column is among the aliases' ids (alias tables are dimension tables: id)."""
    return rows.join(aliases.select(F.col("id").alias(column)).distinct(), column, "left_semi")


def verdict(total: Column, checked: Column) -> Column:
    """V-01: FOUND, or VERIFIED_ABSENT only where the source was checked; otherwise UNKNOWN. Null counts as not checked."""
    return F.when(F.coalesce(total, F.lit(0)) > 0, FOUND).when(F.coalesce(checked, F.lit(False)), ABSENT).otherwise(UNKNOWN)


def zero_reasons(**filters: Column) -> Column:
    """V-12: which filters may explain that nothing was found: (name=condition), joined."""
    return F.array_join(F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in filters.items()])), ", ")


def _shortened(word: Column, most: int) -> Column:
    """The word and what is left of it without any one to `most` of its characters."""
    every = last = F.array(word)
    for _ in range(most):
        without = lambda w: F.transform(F.filter(F.sequence(F.lit(0), F.char_length(w)), lambda i: i > 0), lambda i: F.concat(F.left(w, i - 1), F.substr(w, i + 1)))
        last = F.array_distinct(F.flatten(F.transform(last, without)))
        every = F.array_union(every, last)
    return every


def suggestions(words: DataFrame, dictionary: DataFrame, most: int = 2, k: int = 3) -> DataFrame:
    """D-13: (word) to up to k dictionary entries (name) within an edit distance.

    Two words within the distance become equal when up to `most` characters are taken from each, so the join is on those forms.
    """
    left = words.select("word", F.explode(_shortened(F.lower("word"), most)).alias("form"))
    right = dictionary.select("name", F.explode(_shortened(F.lower("name"), most)).alias("form"))
    near = left.join(right, "form").select("word", "name").distinct().withColumn("distance", F.levenshtein(F.lower("word"), F.lower("name"), most)).where("distance >= 0")
    rank = F.row_number().over(Window.partitionBy("word").orderBy("distance", "name"))
    return near.withColumn("rank", rank).where(F.col("rank") <= k).select("word", "rank", "name", "distance")


def complete_paging(found: DataFrame, total: int, stall: int = 2) -> DataFrame:
    """L-05: found (round, id), pages of a source whose order is not stable, fetched in rounds. (round, new, seen, state), up to the round that ends it.

    state: COMPLETE when all `total` ids have been seen, STALLED after `stall` rounds without a new one, else MORE.
    """
    first = found.groupBy("id").agg(F.min("round").alias("round")).groupBy("round").agg(F.count("*").alias("new"))
    rounds = found.select("round").distinct().join(first, "round", "left").select("round", F.coalesce("new", F.lit(0)).alias("new"))
    w = Window.orderBy("round")  # one row a round
    rounds = rounds.withColumn("seen", F.sum("new").over(w)).withColumn("late", F.sum("new").over(w.rowsBetween(-(stall - 1), 0))).withColumn("nth", F.row_number().over(w))
    state = F.when(F.col("seen") >= total, "COMPLETE").when((F.col("late") == 0) & (F.col("nth") >= stall), "STALLED").otherwise("MORE")
    ended = F.coalesce(F.max((F.col("state") != "MORE").cast("int")).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return rounds.withColumn("state", state).withColumn("ended", ended).where("ended = 0").select("round", "new", "seen", "state")


def keyword_scan(dictionary: DataFrame, name: str, asked: str, most: int = 12) -> DataFrame:
    """S-18: entries (name) that begin with the stem of the asked keyword and contain the stems of its other words, the first `most` in order; exists: whether one is the keyword itself.

    A stem is a word of lower-case letters without its last two where it has over five, as endings are inflected.
    """
    words = [w[:-2] if len(w) > 5 else w for w in asked.lower().split()]
    if not words:
        return dictionary.where(F.lit(False)).select(name, F.lit(False).alias("exists"))
    low = F.lower(name)
    hits = dictionary.where(meets(low.startswith(words[0]), *[low.contains(w) for w in words[1:]])).select(name).distinct()
    # the keyword itself comes first, so it is among those shown wherever the dictionary has it
    exact = (low == asked.lower()).alias("exists")
    return hits.select(name, exact).orderBy(F.col("exists").desc(), name).limit(most)


def newest_first(table: DataFrame, part: str, order: list[Column], number: int, size: int) -> DataFrame:
    """U-04: page `number` of table by falling `part` (a year), then by order, reading only the parts that the page needs.

    The totals of the parts, one row each, say where the page begins and ends; the rest is pruned by a filter on part, which a table that is
    partitioned by it does not even list. Equal to the page of the full sort, nulls of part last.
    """
    totals = sorted(((r[part], r["n"]) for r in table.groupBy(part).agg(F.count("*").alias("n")).collect()), key=lambda x: (x[0] is not None, x[0]), reverse=True)
    skip, first, needed, before = (number - 1) * size, None, [], 0
    for value, n in totals:
        if before + n > skip and before < skip + size:
            first = before if first is None else first
            needed.append(value)
        before += n
    if not needed:
        return table.where(F.lit(False))
    wanted = F.col(part).isin([v for v in needed if v is not None])
    if None in needed:
        wanted = wanted | F.col(part).isNull()
    return table.where(wanted).orderBy(F.col(part).desc_nulls_last(), *order).offset(skip - first).limit(size)
