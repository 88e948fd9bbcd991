"""Boxes of words on pages: rotation, overlap by a grid, layers of text that lie on each other, blocks of notes and what refers to them.

Words are rows (doc, page, seq, x0, y0, x1, y1, word) as in `layout`, y growing downwards; lines are (doc, page, line_no, y0, y1, line).
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .layout import by_page

#: Side of a grid cell, about twice the height of a line.
CELL = 24.0
PAGE = ["doc", "page"]


def upright(words: DataFrame, least: int = 10, share: float = 0.5) -> DataFrame:
    """X-15: words of pages that stand sideways, turned clockwise; column turned says of which. A page is sideways if it has `least` words of four
    characters or more and more than `share` of them are half as tall again as wide. One pre-aggregated row a page."""
    long = F.char_length("word") >= 4
    tall = (F.col("y1") - F.col("y0")) > 1.5 * (F.col("x1") - F.col("x0"))
    per = words.groupBy(*PAGE).agg(F.count_if(long).alias("_n"), F.count_if(long & tall).alias("_tall"), F.max("y1").alias("_foot"))
    per = per.select(*PAGE, "_foot", ((F.col("_n") >= least) & (F.col("_tall") > share * F.col("_n"))).alias("turned"))
    both = words.join(per, PAGE)
    turn = lambda name, other: F.when(F.col("turned"), other).otherwise(F.col(name)).alias(name)
    places = [turn("x0", F.col("_foot") - F.col("y1")), turn("y0", F.col("x0")), turn("x1", F.col("_foot") - F.col("y0")), turn("y1", F.col("x1"))]
    return both.select(*[c for c in words.columns if c not in ("x0", "y0", "x1", "y1")], *places, "turned")


def overlapping(a: DataFrame, b: DataFrame, cell: float = CELL) -> DataFrame:
    """Pairs of boxes of one page with a common area: columns of a, those of b with _b, and area.

    A box is dealt to the cells that it touches and boxes meet on equality of page and cell; a pair counts in the cell with the corner of its common
    area, so it counts once. A box without an area meets nothing.
    """
    at = lambda lo, hi: F.explode(F.sequence(F.floor(F.col(lo) / cell), F.floor(F.col(hi) / cell)))
    right = b.select(*PAGE, *[F.col(c).alias(f"{c}_b") for c in b.columns if c not in PAGE])
    dealt = lambda df, s: df.where(f"x0{s} < x1{s} and y0{s} < y1{s}").withColumn("_cx", at(f"x0{s}", f"x1{s}")).withColumn("_cy", at(f"y0{s}", f"y1{s}"))
    both = dealt(a, "").join(dealt(right, "_b"), [*PAGE, "_cx", "_cy"])
    left, top = F.greatest("x0", "x0_b"), F.greatest("y0", "y0_b")
    wide, high = F.least("x1", "x1_b") - left, F.least("y1", "y1_b") - top
    once = (F.floor(left / cell) == F.col("_cx")) & (F.floor(top / cell) == F.col("_cy"))
    return both.where((wide > 0) & (high > 0) & once).withColumn("area", wide * high).drop("_cx", "_cy")


def covered(words: DataFrame, share: float = 0.5, cell: float = CELL) -> DataFrame:
    """X-17: words of which at least `share` lies under one later word of the page: (doc, page, seq, word, by, same): `by` is the first such later word,
    same says whether it is the same text, so that no word is lost without this one."""
    pairs = overlapping(words, words, cell).where("seq < seq_b").where(F.col("area") >= share * (F.col("x1") - F.col("x0")) * (F.col("y1") - F.col("y0")))
    first = pairs.groupBy(*PAGE, "seq", "word").agg(F.min(F.struct("seq_b", "word_b")).alias("m"))
    return first.select(*PAGE, "seq", "word", F.col("m.seq_b").alias("by"), (F.col("m.word_b") == F.col("word")).alias("same"))


def note_blocks(lines: DataFrame, gap: float = 1.5, smaller: float = 0.9) -> DataFrame:
    """X-18: lines plus in_note: whether they belong to the block of notes at the foot of their page.

    The block begins where, from below, both change: the space above a line is `gap` times the page's usual one or more, and the lines from there on
    are lower than `smaller` of those above; among such lines the one with the largest space, the lowest of equal ones. Its first line begins 'N)'.
    Lines come in order of y0 and stream through the task that has their page; it holds one page. A page without a number has no block.
    """
    numbered = F.coalesce(F.col("line").rlike(r"^\s*\d{1,3}\)"), F.lit(False))
    rows = lines.withColumn("_numbered", numbered).repartition(*PAGE).sortWithinPartitions(*PAGE, "y0", "line_no")
    out = T.StructType([*lines.schema.fields, T.StructField("in_note", T.BooleanType())])
    names = out.names

    def marks(batch: pa.RecordBatch, bounds: list[int]) -> pa.RecordBatch:
        y0, y1 = (pc.cast(batch.column(c), pa.float64()).to_numpy(zero_copy_only=False) for c in ("y0", "y1"))
        may, no, keys = (batch.column(c).to_pylist() for c in ("_numbered", "line_no", "doc"))
        pages = batch.column("page").to_pylist()
        found = np.zeros(len(y0), bool)
        for lo, hi in zip(bounds, bounds[1:], strict=False):
            if keys[lo] is not None and pages[lo] is not None and any(may[lo:hi]):
                start = _block(y0[lo:hi], y1[lo:hi], may[lo:hi], no[lo:hi], gap, smaller)
                found[hi if start is None else lo + start : hi] = True
        return pa.RecordBatch.from_arrays([*[batch.column(c) for c in names[:-1]], pa.array(found)], names)

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_: list[pa.RecordBatch] = []  # of the last page seen, which the next batch may go on with
        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = list(zip(batch.column("doc").to_pylist(), batch.column("page").to_pylist(), strict=True))
            new = [i for i, key in enumerate(keys) if key != (keys[i - 1] if i else last)]
            if open_ and new:
                whole = pa.concat_batches([*open_, batch.slice(0, new[0])])
                yield marks(whole, [0, whole.num_rows])
                open_ = []
            if new:
                if new[0] < new[-1]:
                    yield marks(batch.slice(new[0], new[-1] - new[0]), [i - new[0] for i in new])
                batch = batch.slice(new[-1])
            open_.append(batch)
            last = keys[-1]
        if open_:
            whole = pa.concat_batches(open_)
            yield marks(whole, [0, whole.num_rows])

    return rows.mapInArrow(fold, out)


def _block(y0: np.ndarray, y1: np.ndarray, may: list[bool], no: list, gap: float, smaller: float) -> int | None:
    """Where the block of notes of a page begins; unknown places are not-a-number and count in no mean."""
    spaces, height = np.concatenate([[np.nan], y0[1:] - y1[:-1]]), y1 - y0
    known = ~np.isnan(height)
    high = np.where(known, height, 0.0)
    n, total = np.cumsum(known), np.cumsum(high)
    rest, left = np.cumsum(high[::-1])[::-1], np.cumsum(known[::-1])[::-1]
    usual = max(float(np.median(spaces[~np.isnan(spaces)])), 1e-9) if not np.isnan(spaces).all() else 1e-9
    at, best = None, (-np.inf, -np.inf)
    for i in np.flatnonzero(np.array(may) & (spaces >= gap * usual)).tolist():
        if i and n[i - 1] and left[i] and rest[i] / left[i] < smaller * (total[i - 1] / n[i - 1]) and (spaces[i], y0[i]) >= best:
            # lines come in order of y0 and line_no, so the last of equal ones is the lowest; those that share its place are in the block too
            at, best = i, (spaces[i], y0[i])
    while at and y0[at - 1] == y0[at] and no[at - 1] == no[at]:
        at -= 1
    return at


def _rising(pairs: list[tuple[int, int]]) -> list[int]:
    """Places of a longest run of pairs whose second numbers rise, the pairs being in order of the first."""
    ends: list[int] = []
    at: list[int] = []
    before = [-1] * len(pairs)
    for i, (_, y) in enumerate(pairs):
        k = bisect_left(ends, y)
        before[i] = at[k - 1] if k else -1
        ends[k : k + 1], at[k : k + 1] = [y], [i]
    out, i = [], at[-1] if at else -1
    while i >= 0:
        out.append(i)
        i = before[i]
    return out[::-1]


def references(marked: DataFrame) -> DataFrame:
    """X-18: (doc, page, number, ref_line, note_line): references 'N)' in the body of a page paired with the notes of its block in order; the other side is
    null for a note that nothing refers to and a reference without a note.

    marked: note_blocks(). The k-th reference with a number meets the k-th note with it; of pairs that cross, the most that keep their order stay. Lines
    with a reference or a note stream through the task that has their page; it holds those of one page. Nothing meets on a page without a number.
    """
    number = F.regexp_extract("line", r"^\s*(\d{1,3})\)", 1).try_cast("int")
    said = F.transform(F.regexp_extract_all("line", F.lit(r"(?<=\p{L}|[.,;»”])(\d{1,3})\)"), F.lit(1)), lambda n: n.cast("int"))
    numbers = F.when(F.col("in_note"), F.filter(F.array(number), lambda n: n.isNotNull())).otherwise(said)
    rows = marked.where("in_note is not null and line_no is not null").select(*PAGE, "line_no", "in_note", numbers.alias("numbers")).where(F.size("numbers") > 0)

    def pairs(page: list[tuple]) -> Iterator[tuple]:
        refs = [(number, line) for line, noted, said in page if not noted for number in said]
        notes: dict[int, list[int]] = {}
        for line, noted, said in page:
            if noted:
                notes.setdefault(said[0], []).append(line)
        count: Counter = Counter()
        meets = []  # places in refs, and which of the notes with its number each meets
        for i, (number, _) in enumerate(refs):
            if count[number] < len(notes.get(number, ())):
                meets.append((i, count[number]))
            count[number] += 1
        kept = [meets[j] for j in _rising([(refs[i][1], notes[refs[i][0]][k]) for i, k in meets])]
        done = dict(kept)
        used = {(refs[i][0], k) for i, k in kept}
        yield from ((number, line, notes[number][done[i]] if i in done else None) for i, (number, line) in enumerate(refs))
        yield from ((number, None, line) for number, lines in notes.items() for k, line in enumerate(lines) if (number, k) not in used)

    def fold(page: list[tuple]) -> Iterator[tuple]:
        if page[0][0]:
            return pairs([row[1:] for row in page])
        return ((number, None, line) if noted else (number, line, None) for _, line, noted, said in page for number in said)

    kind = {f.name: f.dataType.simpleString() for f in rows.schema}
    known = (F.col("doc").isNotNull() & F.col("page").isNotNull()).alias("known")
    schema = f"doc {kind['doc']}, page {kind['page']}, number int, ref_line {kind['line_no']}, note_line {kind['line_no']}"
    return by_page(rows.select("*", known), ["known", "line_no", "in_note", "numbers"], [F.col("line_no"), F.col("in_note"), F.col("numbers")], fold, schema)
