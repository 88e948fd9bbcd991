"""Distributed union-find: components of an edge table by alternating large-star and small-star rounds.

Each round is one pre-aggregated minimum for each node and one equi-join, so a hub with a third of all edges is summed before
the shuffle and the join side can be split by AQE. Nothing about nodes or edges reaches the driver but two numbers a round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import Scratch


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star step on edges (u, v) with u > v."""
    both = edges.select("u", "v")
    if large:
        both = both.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    hit = both.join(low, "u")
    if large:
        out = hit.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = hit.where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select("u", F.col("m").alias("v")))
    out = out.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    # a large star makes no more rows than edges, and repeats change no minimum, so the small star's is the only shuffle for them
    return out if large else out.distinct()


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """edges: (a, b), any orderable type; loops and repeats allowed, rows with a null are ignored.

    Returns (node, component) for every node that has an edge; component is the smallest node reachable.
    """
    cur = edges.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    cur = scratch.write(cur)
    seen = _mark(cur)
    while True:
        if not seen[0]:
            break
        nxt = scratch.write(_star(_star(cur, large=True), large=False))
        mark = _mark(nxt)
        scratch.drop(cur)
        cur = nxt
        if mark == seen:
            break
        seen = mark
    low = cur.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return cur.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(low)


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.shiftright(F.xxhash64("v", "u"), 20))).first()
    return tuple(row)
