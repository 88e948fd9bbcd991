"""Operator 2: n-gram Jaccard join with parity sketches.

A document is its set of distinct five-word shingles. Two sets with Jaccard similarity of 0.8 or more differ in at most
d = (size + size) / 9 shingles. In each size band the shingles are dealt by hash to the segments of a sketch and XORed there, so two
sketches differ in at most d segments (and, with one bit a shingle, in at most d bits): of any d + 1 segments at least one agrees.
Each set therefore emits its first segments that hold two or more shingles, a few more than d + 1; sets with too few of those emit
weaker ones too (see _emitted). The rows are joined on equal segments, the Hamming distance of bit sketches discards most false
pairs, and the rest is verified exactly on whole texts. No link is lost: the segments are a pigeonhole argument, not a probability.

Groups never meet pairwise. Sets that are equal are one node from the start, and a task emits the segments of a node once. A segment
that many sets share is hot. A set with no more hot segments than both it and any set it can link with emit beyond d + 1 leaves them
out, which keeps the pigeonhole: this takes care of passages that unlike documents share. The others belong to large families of near copies. A family is compared
with its most central set, and what is not linked to that is joined on differences from it: two members that are close to each other
share a certain number of their differences, so a join on the rarest of these finds them (see buckets.py). Nodes of other segments are
first compared with the segment's smallest node, then with those that are still in another component. Components come from
distributed union-find.

Sets are compared as 64-bit hashes of their shingles, a node is a 64-bit hash of a set: an error needs a collision.

Edge cases: a null or empty text, or one of white space only, has an empty set and links with nothing; rows are told apart by
an id of their own, so rows that repeat a doc_id or have none each get a row (and component) by their own text; a null doc_id never
names a component that has another; an empty table gives an empty result; texts of any
length are read whole; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .buckets import linked_by_keys
from .shared import Scratch, importable
from .shingles import U, mix, shingle_set, word_hashes

#: Shingle length; the similarity of 0.8 is built into the bounds below.
WORDS = 5
#: Size bands grow by this factor; a set just above a border also takes part in the band below.
RATIO = 3
#: Words of the bit sketches that go along with differences.
FOLDED = 16


def band(n: int) -> int:
    s = 0
    while RATIO ** (s + 1) <= n:
        s += 1
    return s


def segments(s: int) -> int:
    """Segments of band s: enough that d + 1 of them hold two or more shingles for nearly every set."""
    return max(16, -(-32 * RATIO ** (s + 1) // 100))


def differ(a: int, b: int) -> int:
    """Most shingles that two linked sets of these sizes differ in."""
    return (a + b) // 9


def bands(n: int) -> list[tuple[int, int]]:
    """(band, d) that a set of n shingles takes part in, d being the largest difference to any set it can link with there."""
    s = band(n)
    out = [(s, differ(n, n * 5 // 4))]
    if s and 4 * n < 5 * RATIO**s:
        out.append((s - 1, differ(n, RATIO**s - 1)))
    return out


def _emitted(seg: np.ndarray, xor: np.ndarray, count: np.ndarray, total: int, d: int, least: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Numbers and contents of the segments a set emits, and how many of them it may leave out where they are hot.

    Linked sets agree in at least one of the first d + 1 segments with two shingles or more of either, and agreeing segments hold
    the same shingles. A set with too few of those emits all that hold a shingle, and one with too few of these all segments.

    Segments outside the difference are the same in both sets, so two sets that emit k and l of the segments with two shingles or more
    agree in all they have, or in min(k, l) - d of them at least. A set with s more than d + 1 may leave out s, and no more than the
    spare ones of its partners; least is the smallest d of any of them. A set that emits weaker segments too may have a partner that
    emits d + 1 of the others, of which one alone agrees, so it leaves out none.
    """
    rich = np.flatnonzero(count >= 2)
    if len(rich) > d:
        rich = rich[: d + 1 + spare(d)]
        return seg[rich], xor[rich], min(len(rich) - d - 1, spare(least))
    if len(seg) > d:
        return seg, xor, 0
    empty = np.setdiff1d(np.arange(total), seg)
    return np.concatenate([seg, empty]), np.concatenate([xor, np.zeros(len(empty), U)]), 0


def spare(d: int) -> int:
    """Segments emitted beyond d + 1 where there are as many."""
    return 3 + d // 16


def least_differ(n: int, s: int) -> int:
    """Smallest d that a set takes part with in band s and that can link with one of n shingles there."""
    least, top = -(-4 * n // 5), RATIO ** (s + 1) - 1
    return min(differ(least, least * 5 // 4), differ(top + 1, top))


def sketch(items: np.ndarray, s: int, d: int) -> np.ndarray:
    """Join keys of a set in band s: hashes of (band, segment, XOR of its shingles)."""
    return sketch_and_slack(items, s, d)[0]


def sketch_and_slack(items: np.ndarray, s: int, d: int) -> tuple[np.ndarray, int]:
    """The join keys of a set in band s, and how many hot ones of them it may leave out whatever its partners emit."""
    total = segments(s)
    part = ((mix(items + U(s)) >> U(32)) * U(total)) >> U(32)
    order = np.argsort(part, kind="stable")
    seg, first, count = np.unique(part[order], return_index=True, return_counts=True)
    xor = np.bitwise_xor.reduceat(items[order], first)
    seg, xor, slack = _emitted(seg.astype(np.int64), xor, count, total, d, least_differ(len(items), s))
    return mix(xor + mix(seg.astype(U) * U(64) + U(s))), slack


def parity_bits(items: np.ndarray, s: int) -> np.ndarray:
    """A sketch of RATIO ** (s + 1) bits or a little more in 64-bit words; each item flips one bit."""
    words = -(-(RATIO ** (s + 1)) // 64)
    bit = ((mix(items ^ U(0x9E3779B97F4A7C15)) >> U(32)) * U(64 * words)) >> U(32)
    flips = np.bincount(bit.astype(np.int64), minlength=64 * words) & 1
    return np.packbits(flips.astype(np.uint8)).view(np.int64)


def node_of(items: np.ndarray) -> int:
    return int((mix(mix(items).sum(dtype=U) + U(len(items)))).astype(np.int64)) if len(items) else 0


def _nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows, ids, node, size, level, bits = [], [], [], [], [], []
        for row, doc, words in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), word_hashes(batch.column(2)), strict=True):
            items = shingle_set(words, WORDS)
            for i, (s, _) in enumerate(bands(len(items)) if len(items) else [(-1, 0)]):
                rows.append(row), ids.append(doc), node.append(node_of(items)), size.append(len(items)), level.append(s if i == 0 else -2 - s)
                bits.append(parity_bits(items, s) if s >= 0 else None)
        yield pa.RecordBatch.from_arrays([pa.array(rows, pa.int64()), pa.array(ids, pa.int64()), pa.array(node, pa.int64()), pa.array(size, pa.int64()), pa.array(level, pa.int32()), pa.array(bits, pa.list_(pa.int64()))], ["uid", "doc_id", "node", "n", "level", "bits"])


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    done: set[int] = set()  # combines equal sets of this task before the shuffle; bounded by the rows of an input split
    for batch in batches:
        keys, nodes, slack = ([np.zeros(0, t)] for t in (np.int64, np.int64, np.int32))
        for words in word_hashes(batch.column(0)):
            items = shingle_set(words, WORDS)
            node = node_of(items)
            if len(items) and node not in done:
                done.add(node)
                for s, d in bands(len(items)):
                    emitted, left_out = sketch_and_slack(items, s, d)
                    keys.append(emitted.view(np.int64))
                    nodes.append(np.full(len(keys[-1]), node))
                    slack.append(np.full(len(keys[-1]), left_out, np.int32))
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (keys, nodes, slack)], ["key", "node", "slack"])


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(a, b, differ, x, y) to (a, b, linked, na, nb, size of the symmetric difference, itself where asked for)."""
    for batch in batches:
        rows: list[list] = [[] for _ in range(5)]
        last, items = None, None
        for name, wanted, x, y in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), batch.column(3), word_hashes(batch.column(4)), strict=True):
            if name != last:
                last, items = name, shingle_set(next(word_hashes(pa.array([x.as_py()]))), WORDS)
            other = shingle_set(y, WORDS)
            both = len(np.intersect1d(items, other, assume_unique=True))
            union = len(items) + len(other) - both
            delta = np.setxor1d(items, other, assume_unique=True).view(np.int64) if wanted else None
            for column, value in zip(rows, (100 * both >= 80 * union, len(items), len(other), union - both, delta), strict=True):
                column.append(value)
        types = (pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *(pa.array(r, t) for r, t in zip(rows, types, strict=True))], ["a", "b", "linked", "na", "nb", "n", "delta"])


def _hamming(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda t, x: t + x)


class _Join:
    """The state of one join: the documents (uid, text), the node table and the shared folder."""

    def __init__(self, docs: DataFrame, nodes: DataFrame, scratch: Scratch):
        self.docs, self.scratch = docs, scratch
        self.bits = nodes.where("n > 0").select("node", F.when(F.col("level") < -1, -2 - F.col("level")).otherwise(F.col("level")).alias("band"), "n", "bits").dropDuplicates(["node", "band"])
        self.first = nodes.where("n > 0").groupBy("node").agg(F.min("uid").alias("uid"))

    def near(self, pairs: DataFrame) -> DataFrame:
        """Those of the pairs (a, b) whose sizes and bit sketches allow a link."""
        left = self.bits.select(F.col("node").alias("a"), "band", F.col("n").alias("na"), F.col("bits").alias("ba"))
        right = self.bits.select(F.col("node").alias("b"), "band", F.col("n").alias("nb"), F.col("bits").alias("bb"))
        fit = "5 * na >= 4 * nb and 5 * nb >= 4 * na"
        return pairs.join(left, "a").join(right, ["b", "band"]).where(fit).where(9 * _hamming(F.col("ba"), F.col("bb")) <= F.col("na") + F.col("nb")).select("a", "b").distinct()

    def close(self) -> tuple[DataFrame, Callable]:
        """(node, sketch): by band, the bit sketch folded to FOLDED words, in which two sets differ in no more bits than they do in shingles; and the test of two."""
        word = lambda i: F.aggregate(F.filter("bits", lambda _, j: j % FOLDED == i), F.lit(0).cast("long"), lambda t, x: t.bitwiseXOR(x))
        folded = self.bits.select("node", "band", F.array(*[word(i) for i in range(FOLDED)]).alias("folded"))
        sketches = folded.groupBy("node").agg(F.map_from_entries(F.collect_list(F.struct("band", "folded"))).alias("sketch"))

        def may(x: Column, y: Column, n: Column, m: Column) -> Column:
            one = lambda band: F.coalesce(9 * _hamming(F.try_element_at(x, band), F.try_element_at(y, band)) <= n + m, F.lit(False))
            return (5 * n >= 4 * m) & (5 * m >= 4 * n) & F.exists(F.map_keys(x), one)

        return self.scratch.write(sketches, hashes=True), may

    def texts(self, pairs: DataFrame) -> DataFrame:
        """(node, text) of one row of each node in pairs."""
        wanted = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
        wanted = wanted.join(self.first, "node")
        return self.docs.select("uid", "text").join(wanted, "uid").select("node", "text")

    def links(self, pairs: DataFrame) -> DataFrame:
        """pairs (a, b, differ) verified on whole texts; differ asks for the differences too."""
        texts = self.scratch.write(self.texts(pairs))
        one = texts.select(F.col("node").alias("a"), F.col("text").alias("x"))
        two = texts.select(F.col("node").alias("b"), F.col("text").alias("y"))
        both = pairs.join(one, "a").join(two, "b").select("a", "b", "differ", "x", "y")
        out = self.scratch.write(both.mapInArrow(_verify, "a long, b long, linked boolean, na long, nb long, n long, delta array<long>"))
        self.scratch.drop(texts)
        return out


def _grouped(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """rows: (uid, doc_id, text), as materialised. (uid, doc_id, n, c) of every row: the size of its set and its group, null for empty sets. The only table left in scratch."""
    importable(rows.sparkSession)
    nodes = scratch.write(rows.mapInArrow(_nodes, "uid long, doc_id long, node long, n long, level int, bits array<long>"))
    join = _Join(rows, nodes, scratch)

    final = linked_by_keys(rows.select("text").mapInArrow(_keys, "key long, node long, slack int"), lambda _: join.links, scratch, join.near, join.close())

    own = nodes.where("level >= -1").select("uid", "doc_id", "node", "n").join(final, "node", "left")
    own = scratch.write(own.select("uid", "doc_id", "n", F.when(F.col("n") > 0, F.coalesce("component", "node")).alias("c")))
    scratch.keep(own)
    return own


def linked_components(docs: DataFrame) -> DataFrame:
    """docs: (doc_id, text). One row per document: doc_id, n_shingles, component_id."""
    scratch = Scratch(docs.sparkSession)
    rows = scratch.write(docs.select(F.monotonically_increasing_id().alias("uid"), F.col("doc_id").cast("long"), "text"))
    own = _grouped(rows, Scratch(docs.sparkSession))
    scratch.keep()
    named = own.where("c is not null").groupBy("c").agg(F.min("doc_id").alias("component_id"))
    full = own.where("c is not null").join(named, "c").select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    return full.unionByName(own.where("c is null").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id")))


def keep_one(docs: DataFrame) -> DataFrame:
    """docs with one row of each component, the first by doc_id (null last) and place; rows with an empty set link with nothing and stay."""
    scratch = Scratch(docs.sparkSession)
    rows = scratch.write(docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.monotonically_increasing_id().alias("uid")))
    own = _grouped(rows.select("uid", F.col("row.doc_id").cast("long").alias("doc_id"), F.col("row.text").alias("text")), Scratch(docs.sparkSession))
    first = own.where("c is not null").groupBy("c").agg(F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "uid")).alias("keep"))
    stay = first.select(F.col("keep.uid").alias("uid")).unionByName(own.where("c is null").select("uid"))
    return rows.join(stay, "uid", "left_semi").select("row.*")
