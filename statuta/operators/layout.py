"""Reading order of pages of positioned words. Where the rule is sequential, pages stream in order through Arrow batches, one at a time.

Words are rows (doc, page, seq, x0, y0, x1, y1, word); lines are (doc, page, line_no, x0, y0, x1, line).
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

#: Rows in a batch of results.
BATCH = 1 << 14
LINES = "doc long, page int, line_no int, x0 double, y0 double, x1 double, line string"


def _values(column: pa.Array) -> list:
    """The values of a column; null numbers with a fraction are not-a-number, as in numpy."""
    fast = pa.types.is_floating(column.type) or pa.types.is_integer(column.type) and not column.null_count
    return column.to_numpy(zero_copy_only=False).tolist() if fast else column.to_pylist()


def by_page(rows: DataFrame, columns: list[str], order: list[Column], fold: Callable[[list[tuple]], Iterable[tuple]], schema: str) -> DataFrame:
    """What fold makes of the rows (columns) of each page in order, behind doc and page. Pages stream through a task, which holds one of them."""
    ordered = rows.select("doc", "page", *columns).repartition("doc", "page").sortWithinPartitions("doc", "page", *order)
    fields = T.StructType.fromDDL(schema)
    types = to_arrow_schema(fields).types

    def pages(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, list[tuple]]]:
        at, page = None, []
        for batch in batches:
            docs, numbers, *said = [_values(c) for c in batch.columns]
            for doc, number, row in zip(docs, numbers, zip(*said, strict=True), strict=True):
                if (doc, number) != at:
                    if page:
                        yield at, page
                    at, page = (doc, number), []
                page.append(row)
        if page:
            yield at, page

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        batch = lambda: pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], fields.names)
        for at, page in pages(batches):
            out += [(*at, *made) for made in fold(page)]
            if len(out) >= BATCH:
                yield batch()
                out = []
        if out:
            yield batch()

    return ordered.mapInArrow(run, schema)


def words_to_lines(words: DataFrame, tolerance: float = 2.5) -> DataFrame:
    """X-15: words by (y0, x0); a word stays on the line whose first word is at most `tolerance` above; a small raised word that
    touches a number is a superscript, written with a caret."""

    def page_lines(page: list[tuple]) -> Iterator[tuple]:
        rows: list[list] = []
        for w in page:
            if not rows or w[0] - rows[-1][0][0] > tolerance:
                rows.append([])
            rows[-1].append(w)
        for n, row in enumerate(rows):
            text, last = "", None
            for w in sorted(row, key=lambda w: (w[1], w[2])):
                y0, x0, _, _, y1, word = w
                raised = last is not None and last[5][-1:].isdigit() and x0 - last[3] < 0.6 and y1 - y0 < 0.8 * (last[4] - last[0]) and last[4] - y1 > 0.3
                text += ("^" if raised else " " if text else "") + word
                last = last if raised else w
            yield n, min(w[1] for w in row), row[0][0], max(w[3] for w in row), text

    double = [F.col(c).cast("double").alias(c) for c in ("y0", "x0", "x1", "y1")]
    boxes = words.select(F.col("doc").cast("long").alias("doc"), F.col("page").cast("int").alias("page"), "seq", "word", *double)
    order = [F.col(c).asc_nulls_last() for c in ("y0", "x0", "seq", "x1", "y1", "word")]
    return by_page(boxes, ["y0", "x0", "seq", "x1", "y1", "word"], order, page_lines, LINES)


def _gutter(full: list[str]) -> int | None:
    """The first column between 35 and 65 per cent of the width that enough lines leave free and most have text on both sides of."""
    width = max(len(x.rstrip()) for x in full)
    low, high = int(0.35 * width), int(0.65 * width)
    free, both = [0] * (high - low + 1), [0] * (high - low + 1)
    for x in full:
        first, end = len(x) - len(x.lstrip()), len(x.rstrip())
        for c in range(low, high + 1):
            if not x[c : c + 2].strip():
                free[c - low] += 1
                both[c - low] += first < c < end
    best, at = 0, None
    for i, n in enumerate(both):
        if free[i] >= 0.6 * len(full) and n >= 0.3 * len(full) and n > best:
            best, at = n, low + i
    return at


def column_order(page_lines: DataFrame) -> DataFrame:
    """X-14: text lines (doc, page, line_no, line) of two-column pages in reading order. The gutter is the column between 35 and 65 per
    cent of the width that most lines leave free; lines across it close a block, and each block is read left column first."""

    def reorder(page: list[tuple]) -> Iterator[tuple]:
        lines = [line or "" for (line,) in page]
        full = [x for x in lines if x.strip()]
        gutter = _gutter(full) if len(full) >= 8 else None
        out, left, right = [], [], []
        for x in lines:
            if gutter is None or (len(x) > gutter and x[gutter : gutter + 2].strip()):
                out += [*left, *right, x.rstrip()]
                left, right = [], []
            else:
                if x[:gutter].strip():
                    left.append(x[:gutter].rstrip())
                if x[gutter:].strip():
                    right.append(x[gutter:].strip())
        return enumerate(out + left + right)

    rows = page_lines.select(F.col("doc").cast("long").alias("doc"), F.col("page").cast("int").alias("page"), "line_no", "line")
    return by_page(rows, ["line"], [F.col("line_no").asc_nulls_last()], reorder, "doc long, page int, line_no int, line string")


def margin_notes(lines: DataFrame, share: float = 0.9) -> DataFrame:
    """X-16: lines with margin: whether they begin right of the edge that most lines of the page end at. The edge is a window's, not a table's that
    is joined: the size of lines made in a row is underrated, so that a join may send all of them to the driver."""
    edge = F.percentile_approx("x1", share * 0.8).over(Window.partitionBy("doc", "page"))
    return lines.withColumn("edge", edge).withColumn("margin", F.col("x0") > F.col("edge") + 0.2)


def notes_to_body(lines: DataFrame) -> DataFrame:
    """X-16: each margin note with the nearest body line at or above it."""
    w = Window.partitionBy("doc", "page").orderBy("y0", F.col("margin").cast("int"), "line_no").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return lines.withColumn("beside", F.last(F.when(~F.col("margin"), F.col("line_no")), ignorenulls=True).over(w)).where("margin").select("doc", "page", "line_no", "beside", "line")


def right_edge(lines: DataFrame) -> DataFrame:
    """A-07: most frequent right edge of each page's lines, the larger of ties."""
    n = lines.groupBy("doc", "page", F.round("x1", 0).alias("edge")).agg(F.count("*").alias("n"))
    return n.groupBy("doc", "page").agg(F.max_by("edge", F.struct("n", "edge")).alias("edge"))


def hidden_layer(lines: DataFrame, height: Column) -> DataFrame:
    """X-17: texts of at least ten characters that a page has in two heights (over 0.5 and 5 per cent apart): the last copy stays."""
    per = lines.where(F.char_length("line") >= 10).groupBy("doc", "page", "line").agg(F.count("*").alias("copies"), F.min(height).alias("low"), F.max(height).alias("high"), F.max("line_no").alias("stays"))
    return per.where("copies > 1 and high - low > 0.5 and high > 1.05 * low")


def footnote_marks(words: DataFrame) -> DataFrame:
    """X-18: words 'N)' that are lower than 0.85 of the word to their left and raised above its foot."""
    w = Window.partitionBy("doc", "page").orderBy("seq")
    tall, foot = F.lag(F.col("y1") - F.col("y0")).over(w), F.lag("y1").over(w)
    marked = words.withColumn("_tall", tall).withColumn("_foot", foot)
    return marked.where(F.col("word").rlike(r"^\d{1,3}\)$") & (F.col("y1") - F.col("y0") < 0.85 * F.col("_tall")) & (F.col("y1") < F.col("_foot"))).drop("_tall", "_foot")


def uncertain_tables(page_lines: DataFrame) -> DataFrame:
    """X-19: blocks of at least three lines with several cells (three blanks apart) that share a column start: (doc, page, first, last).
    Uncertain are blocks with a continuation line that begins left of a cell of the line above."""
    cell = re.compile(r"\S+(?: {1,2}\S+)*")

    def blocks(page: list[tuple]) -> Iterator[tuple]:
        block, blank = [], 0
        for row in [*page, None]:
            cells = [m.start() for m in cell.finditer(row[1] or "")] if row else []
            blank = blank + 1 if row and not cells else 0
            if row is None or blank >= 3 or (cells and len(cells) == 1 and not block):
                multi = [c for _, c in block if len(c) > 1]
                if len(multi) >= 3 and max(Counter(s for c in multi for s in c).values()) >= 3:
                    bad = any(c[0] > a[0] and any(x < y - 1 for x in c for y in a[1:] if abs(x - y) < 6 and x != y) for (_, a), (_, c) in zip(block, block[1:], strict=False))
                    yield block[0][0], block[-1][0], bad
                block = []
            elif cells:
                block.append((row[0], cells))

    rows = page_lines.select(F.col("doc").cast("long").alias("doc"), F.col("page").cast("int").alias("page"), F.col("line_no").cast("int").alias("line_no"), "line")
    return by_page(rows, ["line_no", "line"], [F.col("line_no").asc_nulls_last()], blocks, "doc long, page int, first_line int, last_line int, uncertain boolean")
