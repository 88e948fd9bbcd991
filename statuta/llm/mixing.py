"""Operator 3: mixing sources to target weights.

Tokens are aggregated for each source, targets follow by filling up to caps, and each document is emitted floor(rate) times
plus one hash-seeded Bernoulli copy with probability equal to the fraction of its source's rate (target / size).

Edge cases: a null source is a source of its own (last); a null or empty text has size 0 and is taken 0 words; a source of size 0 has
rate 0; rows that repeat a doc_id, and those without one, draw each by its text and its rank among equal ones; an
empty table gives an empty result; other columns are ignored by plan() and kept by mix(). The table of sources is read in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import word_count

WEIGHTS = (5, 2, 1)
SHARE = 1.5
CAP = 2
#: Shares that equal rows of one doc_id are ranked in.
SHARES = 64


def targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: int = CAP) -> DataFrame:
    """sizes: (source, size). Returns (source, source_size, target, rate), one row per source.

    Weights repeat over the sources in code-point order, null last. A source whose share is above cap times its size stops there
    and the excess is shared out again by weight: with sources ordered by cap / weight the stopped ones are a prefix, so one
    running sum over the table of sources finds the level. That table has one row per source, after pre-aggregation.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    everything = Window.partitionBy(F.lit(0))
    rank = F.row_number().over(everything.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (rank % len(weights) + 1).cast("int"))
    per = per.withColumn("weight", weight).withColumn("most", F.col("source_size") * F.lit(float(cap)))
    by_level = everything.orderBy(F.col("most") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    per = per.select(
        "source", "source_size", "weight", "most",
        F.row_number().over(by_level).alias("i"),
        ((F.sum("source_size").over(everything) * F.lit(float(share)) - F.coalesce(F.sum("most").over(before), F.lit(0.0)))
         / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))).alias("level"),
    )
    free = F.when(F.col("level") * F.col("weight") <= F.col("most"), F.struct("i", "level"))
    per = per.withColumn("level", F.min(free).over(everything)["level"])
    target = F.coalesce(F.least("most", F.col("level") * F.col("weight")), F.col("most"))
    return per.select("source", "source_size", target.alias("target"), F.when(F.col("source_size") > 0, target / F.col("source_size")).otherwise(0.0).alias("rate"))


def draw(key: Column, seed: str) -> Column:
    """A number in [0, 1) that depends on key and seed alone, so reruns and retried tasks agree."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(seed + ":"), F.coalesce(key.cast("string"), F.lit("null")))), 1, 13), 16, 10).cast("double") / float(2**52)


def _with_own(docs: DataFrame) -> DataFrame:
    """docs plus _own: for rows that share a doc_id (or have none) the hash of the text and the row's rank among equal ones, null for all others.

    Ranks of equal rows are a count before their share plus a rank in it, so that no task ranks them all; whichever row has which, the mix is the same.
    """
    often = docs.groupBy(F.col("doc_id").alias("_often")).agg(F.count("*").alias("_n")).where("_n > 1").select("_often", F.lit(True).alias("_shared"))
    if often.isEmpty():
        return docs.withColumn("_own", F.lit(None).cast("string"))
    place = F.monotonically_increasing_id()
    # Spark broadcasts the ids, and the counts below, only under its size limit
    rows = docs.withColumn("_place", place).join(often, F.col("doc_id").eqNullSafe(F.col("_often")), "left").drop("_often")
    rows = rows.withColumn("_hash", F.xxhash64("text")).withColumn("_share", F.when(F.col("_shared"), F.pmod(F.xxhash64("_place"), F.lit(SHARES))).otherwise(F.col("_place")))
    equal = ["doc_id", "source", "_hash"]
    share = Window.partitionBy(*equal, "_share").orderBy("_place")
    before = Window.partitionBy(*equal).orderBy("_share").rowsBetween(Window.unboundedPreceding, -1)
    counts = rows.where("_shared").groupBy(*equal, "_share").agg(F.count("*").alias("_n"))
    counts = counts.select(*[F.col(c).alias(f"{c}_b") for c in (*equal, "_share")], F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    same = F.lit(True)
    for c in (*equal, "_share"):
        same = same & F.col(c).eqNullSafe(F.col(f"{c}_b"))
    rows = rows.withColumn("_rank", F.row_number().over(share)).join(counts, same, "left")
    own = F.when(F.col("_shared"), F.concat_ws(":", "_hash", F.col("_before") + F.col("_rank")))
    return rows.withColumn("_own", own).drop("_place", "_shared", "_hash", "_share", "_rank", "_before", *[f"{c}_b" for c in (*equal, "_share")])


def _drawn(rows: DataFrame, seed: str) -> Column:
    """The draw of each row: by its doc_id, and by its text and rank too where it is not the only one."""
    return draw(F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), "_own"), seed)


def _copies(docs: DataFrame, seed: str, **options) -> DataFrame:
    """docs with the columns size, source_size, target and copies added in the struct _mix."""
    sizes = docs.select("source", word_count(F.col("text")).alias("size"))
    goal = targets(sizes, **options).select(F.col("source").alias("_s"), "source_size", "target", "rate")
    # Spark broadcasts this side only if its measured size is under the session's threshold; else a sort-merge join, whose hot sources AQE splits
    both = _with_own(docs).withColumn("_size", word_count(F.col("text"))).join(goal, F.col("source").eqNullSafe(F.col("_s")))
    whole = F.floor("rate")
    copies = whole + (_drawn(both, seed) < F.col("rate") - whole).cast("long")
    return both.withColumn("_mix", F.struct(F.col("_size").alias("size"), "source_size", "target", copies.alias("copies"))).drop("_size", "_s", "_own", "source_size", "target", "rate")


def plan(docs: DataFrame, seed: str = "mix", **options) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken."""
    narrow = _copies(docs.select("doc_id", "text", "source"), seed, **options)
    return narrow.select("doc_id", "_mix.size", "_mix.source_size", "_mix.target", (F.col("_mix.size") * F.col("_mix.copies")).alias("taken"))


def mix(docs: DataFrame, seed: str = "mix", **options) -> DataFrame:
    """The mixed corpus: every column of docs, each document as often as its draw says."""
    names = docs.columns
    packed = docs.select("doc_id", "text", "source", F.struct(*[F.col(f"`{c}`") for c in names]).alias("_row"))
    out = _copies(packed, seed, **options).where("_mix.copies > 0")
    return out.select("_row", F.explode(F.sequence(F.lit(1), F.col("_mix.copies"))).alias("_copy")).select("_row.*")
