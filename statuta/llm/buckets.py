"""Components of the links among sets that share a key, without comparing all pairs of a large group.

Nodes of a key with few nodes are first compared with its smallest node, then with those that are still in another component. A key
with more nodes is hot: its nodes are a family, compared with the node that shares most hot keys. If that leaves some unlinked, the
family gets a better center, the node closest to what most of its nodes have in common, and what is not linked to that either is joined
on differences from it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .components import components
from .shared import Scratch

#: A key that more nodes share is hot.
HOT = 8
#: Members, about, that are asked what most of a family have, and which differences are frequent. Any set serves to take differences from and any order
#: to sort them by, so this bounds only how well both are chosen: a near set makes fewer differences, and rare ones first make fewer meetings.
ASKED, SORTED = 8, 24


def linked_by_keys(keys: DataFrame, verifier: Callable, scratch: Scratch, near: Callable = lambda pairs: pairs, close: tuple[DataFrame, Callable] | None = None) -> DataFrame:
    """keys: (key, node, slack), repeats allowed. Returns (node, component) of every node with a link.

    slack: how many hot keys a node may leave out so that it still shares another with every node it links with. near: keeps the pairs (a, b) that may link.
    close: (node, sketch) of every node, small, and whether two nodes of sketches s and s2 and sizes n and n2 may link, where that is known.
    verifier: given the nodes (node) that share a key, returns a function from pairs (a, b, differ) to (a, b, linked, na, nb, n, delta):
    whether sets a and b have a Jaccard similarity of 0.8 or more, their sizes, and the number of their differences, with the
    differences themselves where differ is true and null elsewhere.
    """
    is_hot = F.col("rows") > HOT
    # running values over a sort, which spills and holds no group: nodes of a key that is not theirs alone
    by_key = Window.partitionBy("key").orderBy("node")
    hub = F.first("node").over(by_key.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    first_slack = F.first("slack").over(by_key.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    shared = keys.select("key", "node", "slack", hub.alias("hub"), first_slack.alias("hub_slack"), F.lag("node").over(by_key).alias("last")).where("node != hub and node != last")
    shared = scratch.write(shared.drop("last"), hashes=True)
    links_of = verifier(shared.select(F.explode(F.array("node", "hub")).alias("node")).distinct())
    counts = shared.groupBy("key").agg((F.count("*") + 1).alias("rows"), F.first("hub").alias("node"), F.first("hub_slack").alias("slack"))
    hot = scratch.write(counts.where(is_hot))
    # told apart once, as both parts are read several times
    parted = scratch.write(shared.join(hot.select("key", F.lit(True).alias("hot")), "key", "left"), hashes=True)
    cold = parted.where("hot is null")
    members = parted.where("hot").select("key", "node", "slack").unionByName(hot.select("key", "node", "slack"))
    burden = members.groupBy("node").agg(F.count("*").alias("burden"), F.min("slack").alias("slack")).where("burden > slack").select("node", "burden")
    family = scratch.write(members.select("key", "node").join(burden, "node"))
    center = family.groupBy("key").agg(F.max_by("node", F.struct("burden", "node")).alias("center"))
    frames = scratch.write(family.join(center, "key").select("center", "node").distinct())

    # round 1: members of families against the center, others against the hub that they share most keys with
    votes = cold.groupBy("hub", "node").agg(F.count("*").alias("votes"))
    best = votes.groupBy("node").agg(F.max_by("hub", F.struct("votes", "hub")).alias("hub")).select(F.col("hub").alias("a"), F.col("node").alias("b"))
    likely = near(best).withColumn("differ", F.lit(False))
    central = frames.where("center != node").select(F.col("center").alias("a"), F.col("node").alias("b"), F.lit(True).alias("differ"))
    done = links_of(scratch.write(likely.join(central.select("a", "b"), ["a", "b"], "left_anti").unionByName(central)))
    families = scratch.write(_recentred(done.where("delta is not null"), scratch))
    links = done.where("linked").select("a", "b").unionByName(families.where("linked").select(F.col("center").alias("a"), "b"))
    found = scratch.write(components(links, scratch))

    # round 2: nodes that share a cold key or are close in a family, and are not in one component yet
    own = cold.select("key", "node").unionByName(cold.select("key", F.col("hub").alias("node")).distinct())
    pairs = _unlinked(own, found, scratch).unionByName(_families(families, found, scratch, close)).distinct()
    tried = done.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    rest = near(scratch.write(pairs).join(tried, ["a", "b"], "left_anti")).withColumn("differ", F.lit(False))
    more = links_of(scratch.write(rest))
    return _merged(found, more.where("linked").select("a", "b"), scratch)


def _merged(found: DataFrame, links: DataFrame, scratch: Scratch) -> DataFrame:
    """Components (node, component) found with links (a, b) added: only components that a link joins are worked on again."""
    of = lambda end: found.select(F.col("node").alias(end), F.col("component").alias(f"c{end}"))
    ends = links.join(of("a"), "a", "left").join(of("b"), "b", "left")
    joined = scratch.write(components(ends.select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b")), scratch))
    new = joined.join(found.select("node"), "node", "left_anti")
    after = found.join(joined.select(F.col("node").alias("component"), F.col("component").alias("joined")), "component", "left")
    return scratch.write(after.select("node", F.coalesce("joined", "component").alias("component")).unionByName(new))


def _unlinked(members: DataFrame, found: DataFrame, scratch: Scratch) -> DataFrame:
    """Pairs (a, b), with repeats, of nodes that share a key, of at most HOT nodes, and are in different components."""
    members = members.join(found, "node", "left").select("key", "node", F.coalesce("component", "node").alias("c"))
    of_key = Window.partitionBy("key")  # no more than HOT rows
    mixed = members.select("key", "node", "c", F.min("c").over(of_key).alias("lo"), F.max("c").over(of_key).alias("hi")).where("lo != hi")
    open_ = scratch.write(mixed.select("key", "node", "c"), hashes=True)
    other = open_.select("key", F.col("node").alias("b"), F.col("c").alias("cb"))
    return open_.select("key", F.col("node").alias("a"), F.col("c").alias("ca")).join(other, "key").where("a < b and ca != cb").select("a", "b")


def _recentred(done: DataFrame, scratch: Scratch) -> DataFrame:
    """Families with unlinked members, on a better center: (a, center, b, linked, nb, n, delta), a naming the family.

    done: members b with their differences delta, n in number, from the first center a. Differences that most members have are the first
    center's own, so without them it is the set of what most members have in common. The result's differences are those from that set,
    center is the member closest to it, and linked says whether b links with center, which the differences of both decide exactly: sets
    x and y link when 9 * |x and y differ in| <= |x| + |y|. Where unlike sets only share a passage, that passage is the common set.
    """
    open_ = done.groupBy("a").agg(F.min("linked").alias("all"), F.max("na").alias("na"), F.count("*").alias("members")).where("not all")
    open_ = scratch.write(open_.select("a", "na", "members"))
    none = F.array().cast("array<bigint>")
    first = open_.select("a", F.col("a").alias("b"), F.col("na").alias("nb"), none.alias("delta"), "members")
    rows = scratch.write(done.join(open_.select("a", "members"), "a").select("a", "b", "nb", "delta", "members").unionByName(first), hashes=True)
    asked = rows.where(F.pmod(F.xxhash64("b"), F.col("members")) < ASKED)
    usual = asked.select("a", F.explode("delta").alias("e")).groupBy("a", "e").agg(F.count("*").alias("n")).join(asked.groupBy("a").agg(F.count("*").alias("asked")), "a").where("2 * n > asked + 1")
    usual = scratch.write(usual.groupBy("a").agg(F.collect_list("e").alias("usual")))  # at most twice as many as a member has
    apart = lambda x, y: F.concat(F.array_except(x, y), F.array_except(y, x))
    rows = scratch.write(rows.join(usual, "a", "left").select("a", "b", "nb", apart("delta", F.coalesce("usual", none)).alias("delta")), hashes=True)
    center = scratch.write(rows.groupBy("a").agg(F.min_by(F.struct("b", "nb", "delta"), F.struct(F.size("delta"), "b")).alias("m")))
    both = rows.join(center, "a").where("b != m.b").withColumn("apart", F.size(apart("delta", "m.delta")))
    return both.select("a", F.col("m.b").alias("center"), "b", (9 * F.col("apart") <= F.col("m.nb") + F.col("nb")).alias("linked"), "nb", F.size("delta").cast("long").alias("n"), "delta")


def _families(done: DataFrame, found: DataFrame, scratch: Scratch, close: tuple[DataFrame, Callable] | None = None) -> DataFrame:
    """Pairs (a, b), with repeats, of a family that may link though they are in different components.

    done: members b of family a with their differences delta, n in number, from one set. Let D(x) be the differences of x, and d(x) the
    most that x and a set it links with differ in. Linked x and y have (n(x) + n(y) - |x and y differ in|) / 2 differences in common,
    and as n(y) is no less than those, at least n(x) - d(x). Of sets with so much in common the first n - common + 1 differences, in any
    order that is one for the family, have one in common; only those become rows. The order puts differences last that some asked members
    share, the most frequent at the very end, so that few members meet on one. Where sketches are given, the join compares those of members that meet,
    so only pairs that may link become rows.
    """
    rows = done.join(found.select(F.col("node").alias("b"), "component"), "b", "left").select("a", "b", "nb", "n", "delta", F.coalesce("component", "b").alias("c"))
    mixed = rows.groupBy("a").agg(F.min("c").alias("lo"), F.max("c").alias("hi"), F.count("*").alias("members")).where("lo != hi").select("a", "members")
    rows = scratch.write(rows.join(mixed, "a"), hashes=True)
    asked = rows.where(F.pmod(F.xxhash64("b"), F.col("members")) < SORTED).select("a", F.explode("delta").alias("e"))
    often = asked.groupBy("a", "e").agg(F.count("*").alias("times")).where("times > 1")
    often = scratch.write(often.groupBy("a").agg(F.array_sort(F.collect_list(F.struct("times", "e"))).alias("o")).select("a", F.transform("o", lambda x: x["e"]).alias("often")))  # no more than SORTED members have
    common = F.greatest(F.lit(1), F.col("n") - F.floor((F.col("nb") + F.floor(5 * F.col("nb") / 4)) / 9))
    last = F.coalesce("often", F.array().cast("array<bigint>"))
    order = F.concat(F.array_sort(F.array_except("delta", last)), F.array_intersect(last, F.col("delta")))
    first = F.slice(order, F.lit(1), (F.col("n") - common + 1).cast("int"))
    prefix = rows.join(often, "a", "left").select("a", "b", "c", "nb", "n", F.posexplode(first).alias("at", "e")).withColumn("at", F.col("at") + 1)
    prefix = scratch.write(prefix, hashes=True)
    sketch = ["sketch"] if close else []
    if close:  # only rows that meet another get their sketch; without sketches the join below is as cheap as finding those rows
        shared = prefix.groupBy("a", "e").agg(F.min("b").alias("lo"), F.max("b").alias("hi")).where("lo != hi").select("a", "e")
        prefix = prefix.join(shared, ["a", "e"]).join(close[0].select(F.col("node").alias("b"), "sketch"), "b")
        prefix = scratch.write(prefix, hashes=True)
    other = prefix.select("a", "e", *[F.col(c).alias(f"{c}2") for c in ("b", "c", "nb", "n", "at", *sketch)])
    # the first difference in common leaves at most the rest of the shorter one for the others
    enough = "2 * (1 + least(n - at, n2 - at2)) >= n + n2 - floor((nb + nb2) / 9)"
    met = prefix.join(other, ["a", "e"]).where("b < b2 and c != c2").where(enough)
    if close:
        met = met.where(close[1](F.col("sketch"), F.col("sketch2"), F.col("nb"), F.col("nb2")))
    return met.select(F.col("b").alias("a"), F.col("b2").alias("b"))
