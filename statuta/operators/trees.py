"""Trees of units as nested intervals: a node's descendants are those numbered left + 1 to right of its root, at any depth.

Paths come from pointer doubling (rounds grow with the logarithm of the depth), sizes of subtrees from one count over path members, and the number
of a node is the sum, along its path, of what stands before each member under its parent. Then "under" and "above" are comparisons with a running
extreme in document order: one window, no recursion and no join.

A node without a parent, or with one that the table does not have, is a root and starts a numbering of its own; nodes on a cycle, and those below
one, belong to no root and are left out; node ids must be unique. Siblings that tie in the given order follow by id. The children of one parent are
summed in one task, which spills.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .rounds import settled


def paths(nodes: DataFrame, node: str, parent: str) -> DataFrame:
    """(node, parent, path): path holds the nodes from the root to the node itself."""
    known = nodes.select(F.col(node).alias("_known"))
    rows = nodes.select(F.col(node).alias("node"), F.col(parent).alias("up")).join(known, F.col("up") == F.col("_known"), "left")
    rows = settled(rows.select("node", F.col("_known").alias("parent"), F.col("_known").alias("up"), F.array("node").alias("path")))
    open_ = rows.where("up is not null").count()
    while open_:
        above = rows.select(F.col("node").alias("_n"), F.col("up").alias("_up"), F.col("path").alias("_path"))
        rows = rows.join(above, F.col("up") == F.col("_n"), "left").select("node", "parent", F.col("_up").alias("up"), F.when(F.col("_n").isNotNull(), F.concat("_path", "path")).otherwise(F.col("path")).alias("path"))
        rows = settled(rows)
        left = rows.where("up is not null").count()
        if left == open_:  # a round finishes some nodes of every tree, so what is left hangs on cycles
            break
        open_ = left
    return rows.where("up is null").select("node", "parent", "path")


def nested_intervals(nodes: DataFrame, node: str, parent: str, order: Column | None = None) -> DataFrame:
    """S-08: nodes' columns with root, depth, left and right: preorder numbers of the node and of its last descendant, from 1 for each root."""
    known = paths(nodes, node, parent)
    placed = known.select("node", "parent", F.col("path")[0].alias("root"), (F.size("path") - 1).alias("depth"), "path")
    members = placed.select("node", F.explode("path").alias("member"))
    sizes = members.groupBy(F.col("member").alias("node")).agg(F.count("*").alias("size"))
    own = nodes.select(F.col(node).alias("node"), (order if order is not None else F.col(node)).alias("_order"))
    sized = settled(placed.join(sizes, "node").join(own, "node"))
    before = Window.partitionBy("parent").orderBy("_order", "node").rowsBetween(Window.unboundedPreceding, -1)
    steps = sized.where("parent is not null").select(F.col("node").alias("member"), (F.coalesce(F.sum("size").over(before), F.lit(0)) + 1).alias("step"))
    left = members.join(steps, "member").groupBy("node").agg(F.sum("step").alias("_left"))
    numbered = sized.join(left, "node", "left").withColumn("left", F.coalesce("_left", F.lit(0)) + 1)
    numbered = numbered.select(F.col("node").alias(node), "root", "depth", "left", (F.col("left") + F.col("size") - 1).alias("right"))
    return nodes.join(numbered, node)


def _until(order: Column) -> Window:
    """The nodes of a root from the first in an order to the node itself. Frames that only grow are read once; one that begins at each row is not."""
    return Window.partitionBy("root").orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)


def under(tree: DataFrame, hit: Column) -> Column:
    """Whether a node is a hit or below one: intervals nest, so some hit before it in document order reaches it."""
    return F.coalesce(F.max(F.when(hit, F.col("right"))).over(_until(F.col("left"))) >= F.col("left"), F.lit(False))


def above(tree: DataFrame, hit: Column) -> Column:
    """Whether a node is a hit or above one: the next hit in document order, which is the smallest on the way from the end, lies in its interval."""
    return F.coalesce(F.min(F.when(hit, F.col("left"))).over(_until(F.col("left").desc())) <= F.col("right"), F.lit(False))


def filtered(tree: DataFrame, hit: Column, below: bool = False, depth: int | None = None) -> DataFrame:
    """S-08: the hits of a text filter with their ancestors (below: their descendants too), down to a depth; column hit tells them apart."""
    hit = F.coalesce(hit, F.lit(False))
    rows = tree.withColumn("hit", hit).withColumn("_above", above(tree, hit)).withColumn("_under", under(tree, hit) if below else F.lit(False))
    rows = rows.where(F.col("_above") | F.col("_under")).drop("_above", "_under")
    return rows.where(F.col("depth") <= depth) if depth is not None else rows
