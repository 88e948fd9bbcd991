"""Operator 8: exact deduplication by deterministic block naming.

Each normalised text is cut into blocks of a fixed number of characters. Equal blocks get one integer, found by comparing the
blocks themselves, so two different blocks never share a name. Adjacent names are then named pairwise, level by level, until each
document has a single name; documents with the same number of blocks are equal exactly when their last names are.

Edge cases: a null text counts as empty; the empty text is one empty block; a null doc_id ranks after all others; of rows that repeat
a doc_id and a text one stays; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import SPACE_RUN, Scratch

#: Characters in a block: most documents are one or two blocks, and no shuffled row is large.
BLOCK = 4096


def _named(rows: DataFrame, keys: list[str]) -> DataFrame:
    """rows plus name: one integer for each distinct value of keys, which hold no nulls.

    The minimum of the row number n is taken for each distinct key, pre-aggregated before the shuffle, and joined back.
    """
    return rows.join(rows.groupBy(*keys).agg(F.min("n").alias("name")), keys)


def identities(docs: DataFrame, block: int, scratch: Scratch) -> DataFrame:
    """(uid, doc_id, sha, blocks, name): one row per document; equal texts have equal (blocks, name).

    Block rows are numbered once, in the order of the scan, and their numbers are written with the names of the blocks. A pair takes the
    number of its first block row, so names of later levels do not depend on the order in which a shuffle delivers rows, nor on reruns.
    """
    text = F.regexp_replace(F.coalesce("text", F.lit("")), SPACE_RUN, " ")
    rows = docs.select("doc_id", F.monotonically_increasing_id().alias("uid"), text.alias("text"))
    cut = F.regexp_extract_all("text", F.lit("(?s).{1,%d}" % block), F.lit(0))
    rows = rows.select("uid", "doc_id", F.sha2("text", 256).alias("sha"), F.when(F.col("text") == "", F.array(F.lit(""))).otherwise(cut).alias("parts"))
    rows = rows.select("uid", "doc_id", "sha", F.size("parts").alias("blocks"), F.posexplode("parts").alias("pos", "block"))
    rows = rows.select("uid", "pos", "blocks", "block", F.monotonically_increasing_id().alias("n"), *[F.when(F.col("pos") == 0, F.col(c)).alias(c) for c in ("doc_id", "sha")])
    first = scratch.write(_named(rows, ["block"]).drop("block"))
    done = first.where("blocks = 1").select("uid", "doc_id", "sha", "blocks", "name")
    head = first.where("blocks > 1 and pos = 0").select("uid", "doc_id", "sha")
    most = first.agg(F.max("blocks")).first()[0] or 0
    left, level, ends = first.where("blocks > 1").select("uid", "pos", "blocks", "name", "n"), 1, []
    while 2 ** (level - 1) < most:
        even, odd = (F.max(F.when(F.col("pos") % 2 == k, F.col("name"))) for k in (0, 1))
        pairs = left.groupBy("uid", F.shiftright("pos", 1).alias("pos"), "blocks").agg(even.alias("l"), F.coalesce(odd, F.lit(-1)).alias("r"), F.min("n").alias("n"))
        table = scratch.write(_named(pairs, ["l", "r"]).drop("l", "r"))
        ends.append(table.where(F.col("blocks") <= 2**level).select("uid", "blocks", "name"))
        left, level = table.where(F.col("blocks") > 2**level), level + 1
    if ends:
        last = ends[0]
        for e in ends[1:]:
            last = last.unionByName(e)
        done = done.unionByName(last.join(head, "uid").select("uid", "doc_id", "sha", "blocks", "name"))
    return done


def exact_dedup(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """One row per document, dropped ones too: doc_id, keep_id, group_size, kept, text_sha256."""
    scratch = Scratch(docs.sparkSession)
    done = identities(docs.select("doc_id", "text"), block, scratch)
    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "uid")
    groups = done.groupBy("blocks", "name").agg(F.min(order).alias("first"), F.count("*").alias("group_size"))
    return done.join(groups, ["blocks", "name"]).select(
        "doc_id", F.col("first.doc_id").alias("keep_id"), "group_size", (F.col("uid") == F.col("first.uid")).alias("kept"), F.col("sha").alias("text_sha256")
    )


def keep_first(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """docs without the later copies; of rows that repeat a doc_id and a text one stays, and a null doc_id ranks last."""
    scratch = Scratch(docs.sparkSession)
    rows = scratch.write(docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.monotonically_increasing_id().alias("uid")))
    done = identities(rows.select(F.struct("row.doc_id", "uid").alias("doc_id"), "row.text"), block, scratch)
    order = F.struct(F.col("doc_id.doc_id").isNull().alias("last"), F.col("doc_id.doc_id").alias("doc_id"), F.col("doc_id.uid").alias("uid"))
    stay = done.groupBy("blocks", "name").agg(F.min(order)["uid"].alias("uid")).select("uid")
    return rows.join(stay, "uid", "left_semi").select("row.*")
