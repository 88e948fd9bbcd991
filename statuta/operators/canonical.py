"""Text lines of many pages as the paragraphs of one text (X-21): furniture out, columns in reading order, notes apart, paragraphs across pages.

Lines that most pages of a document share are found first, by counting shapes (X-12); that needs all pages. The rest is one pass over the lines of each
document in order, which carries from page to page what a page alone does not tell: the gutter of the last two-column page, the paragraph that is
open at the foot of a page, and the note that goes on at the foot of the next one. Lines stream through the task that has their document; it holds
one page and what is open.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .passages import page_furniture

#: What begins a paragraph: a unit's mark, or a line that is set in deeply or like a row of a table.
_MARK = re.compile(r"^\s*(?:Art\.|§|Rozdział|\d+[.)]|[a-z]\))")
_DEEP = re.compile(r"^ {16}")
_SPACES = re.compile(r"\s{2,}")
_CELLS = re.compile(r"\S {3,}\S")
_NOTE = re.compile(r"^\s*(\d{1,3})\)\s+\S")
#: Lines of a page from which columns are looked for.
LEAST = 8


def gutter(lines: list[str], least: int = LEAST) -> int | None:
    """The column between 35 and 65 per cent of the width that most lines leave free, with text on both sides in enough of them."""
    full = [x for x in lines if x.strip()]
    if len(full) < least:
        return None
    width = max(len(x.rstrip()) for x in full)
    low, high = int(0.35 * width), int(0.65 * width)
    free, both = [0] * (high - low + 2), [0] * (high - low + 2)  # changes from one column to the next

    def add(to: list[int], first: int, last: int) -> None:
        if max(first, low) <= min(last, high):
            to[max(first, low) - low] += 1
            to[min(last, high) - low + 1] -= 1

    for x in full:
        first, end = len(x) - len(x.lstrip()), len(x.rstrip())
        add(free, 0, first - 2)
        add(free, end, high)
        for m in _SPACES.finditer(x, max(first, low - 1), max(first, min(end, high + 2))):
            add(free, m.start(), m.end() - 2)
            add(both, m.start() + 1, m.end() - 2)
    best, at = 0, None
    for c, (n, m) in enumerate(zip(accumulate(free[:-1]), accumulate(both[:-1]), strict=True), low):
        if n >= 0.6 * len(full) and m >= 0.3 * len(full) and m > best:
            best, at = m, c
    return at


def reading_order(lines: list[str], at: int | None) -> list[str]:
    """Left column before right one in each block; a line across the gutter ends a block."""
    if at is None:
        return lines
    out, left, right = [], [], []
    for x in [*lines, None]:
        if x is None or len(x) > at and x[at : at + 2].strip():
            out += left + right
            left, right = [], []
            if x is not None:
                out.append(x.rstrip())
        else:
            if x[:at].strip():
                left.append(x[:at].rstrip())
            if x[at:].strip():
                right.append(x[at:].strip())
    return out


def joined(a: str, b: str) -> str:
    """Two lines of a paragraph: a word that was cut with a hyphen before a small letter becomes whole again."""
    if re.search(r"[^\W\d_][-­]$", a) and re.match(r"[^\W\d_]", b) and b[0].islower():
        return a[:-1] + b
    return f"{a} {b}" if a else b


@dataclass
class Document:
    """What is open while the pages of a document pass."""

    at: int | None = None
    body: list = field(default_factory=list)  # [first page, last page, text] of the open paragraph
    note: list = field(default_factory=list)
    blank: bool = True
    done: list = field(default_factory=list)  # (kind, first page, last page, text)

    def close(self, which: str) -> None:
        open_ = getattr(self, which)
        if open_:
            self.done.append((which, *open_))
            setattr(self, which, [])

    def add(self, which: str, page: int, line: str, new: bool) -> None:
        if new:
            self.close(which)
        open_ = getattr(self, which)
        text = line.strip()
        setattr(self, which, [open_[0], page, joined(open_[2], text)] if open_ else [page, page, text])

    def page(self, page: int, lines: list[str]) -> None:
        body, notes = split_notes(lines, bool(self.note))
        found = gutter(body)
        # a page too short to tell keeps the columns of the one before
        self.at = found if found is not None or len([x for x in body if x.strip()]) >= LEAST else self.at
        for line in reading_order(body, self.at):
            if not line.strip():
                self.blank = True
                continue
            self.add("body", page, line, self.blank or bool(_DEEP.match(line) or _CELLS.search(line.strip()) or _MARK.match(line)))
            self.blank = False
        for line in notes:
            self.add("note", page, line, bool(_NOTE.match(line)))
        if not notes:
            self.close("note")

    def end(self) -> list[tuple]:
        self.close("body")
        self.close("note")
        return self.done


def split_notes(lines: list[str], open_: bool) -> tuple[list[str], list[str]]:
    """(body, notes) of a page: the last block after two blank lines or more, if it begins 'N)', or, where a note is open, if it has a rule above."""
    last = len(lines)
    while last and not lines[last - 1].strip():
        last -= 1
    blanks, start = 0, None
    for i in range(last - 1, -1, -1):
        if lines[i].strip():
            if blanks >= 2:
                start = i + blanks + 1
                break
            blanks = 0
        else:
            blanks += 1
    if start is None:
        return lines, []
    first = lines[start]
    ruled = bool(re.fullmatch(r"\s*[_─—-]{5,}\s*", first))
    block = lines[start + ruled : last]
    if block and (_NOTE.match(block[0]) or open_ and ruled):
        return lines[: start - 2], block
    return lines, []


OUT = "kind string, para int, first_page int, last_page int, text string"


def canonical(lines: DataFrame, share: float = 0.6) -> DataFrame:
    """X-21: lines (doc, page, line_no, line) as (doc, kind, para, first_page, last_page, text): paragraphs of the body, numbered from 1 in order, and notes.

    Blank lines only separate; a document of blank lines has no row; a null line is a blank one, and rows without a doc are one document.
    """
    kind = lines.schema["doc"].dataType
    shape = F.regexp_replace(F.trim("line"), r"\d+", "#")
    common = page_furniture(lines, "doc", "page", F.col("line"), share).select(F.col("doc").alias("_doc"), F.col("shape").alias("_shape"))
    kept = lines.join(common, (F.col("doc") == F.col("_doc")) & (shape == F.col("_shape")), "left_anti")
    ordered = kept.select("doc", F.col("page").cast("int"), "line_no", "line").repartition("doc").sortWithinPartitions("doc", "page", "line_no").select("doc", "page", "line")
    names = ["doc", *[c.split()[0] for c in OUT.split(", ")]]
    types = [pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.string()]

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at: tuple = ()
        state, page, of = Document(), [], None
        counts: dict[str, int] = {}
        docs: list = []
        out: list[tuple] = []

        def take() -> None:
            for which, *said in state.done:
                counts[which] = counts.get(which, 0) + 1
                docs.append(at[0])
                out.append((which, counts[which], *said))
            state.done = []

        for batch in batches:
            of = batch.schema.field(0).type
            for doc, number, line in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if (doc, number) != at:
                    if at:
                        state.page(at[1], page)
                        if doc != at[0]:
                            state.end()
                            take()
                            state, counts = Document(), {}
                        else:
                            take()
                    at, page = (doc, number), []
                page.append(line or "")
            if len(out) >= 4096:
                yield pa.RecordBatch.from_arrays([pa.array(docs, of), *[pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)]], names)
                docs, out = [], []
        if at:
            state.page(at[1], page)
            state.end()
            take()
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(docs, of), *[pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)]], names)

    return ordered.mapInArrow(fold, f"doc {kind.simpleString()}, {OUT}")
