"""Operator 5: best-fit-decreasing packing of tokenised documents into sequences of a fixed capacity.

Documents are tokenised where they are read and cut into pieces of at most one capacity; only (piece, length) rows travel. All pieces
of the table are packed together: there are at most `capacity` different lengths, so the driver packs their counts, length by length,
and the tightest open sequences for each come from a segment tree over remaining capacities in logarithmic time. Sequences that
are filled alike are handled as one run, and pieces find their place by their rank among the pieces of their length, which is a count
of each task plus a running sum over tasks. The number of sequences is that of best-fit decreasing over the whole table.

The plan is bounded whatever the table holds: a length adds at most four runs, and a run that takes pieces of length n keeps less than
half of its room, so it is touched at most 13 times: 13 * 4 * 4096 rows of five numbers for a capacity of 4096.

Edge cases: a null or empty text is the end token alone; a null doc_id stays null and others keep all 64 bits; rows that repeat a
doc_id are packed each on its own; an empty table gives an empty result; other columns are ignored; a text of any length is tokenised whole.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import Scratch, importable

CAPACITY = 4096
END = 1
#: Words whose ids a worker remembers in each of two generations: a full one becomes the older one, from which words in use come back.
REMEMBERED = 1 << 18

_loaded: dict[str, Words] = {}


class Words(dict):
    """Token ids (little-endian uint32 bytes) of white-space-delimited words, in ASCII lower case, as the tokenizer gives them.

    The tokenizer drops white space and never joins across it, and lower-cases, so a text's ids are those of its words in a row.
    Plain ASCII words are split here as its pre-tokenizer does and go to its model; all others go through the whole tokenizer.
    """

    ASCII = re.compile(rb"[!-~]+")
    PARTS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^a-z0-9]+")

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.parts: dict[str, bytes] = {}
        self.older: dict[bytes, bytes] = {}

    def __missing__(self, word: bytes) -> bytes:
        out = self.older.get(word)
        if out is not None:
            pass
        elif self.ASCII.fullmatch(word):
            out = b"".join([self.part(p) for p in self.PARTS.findall(word.decode())])
        else:
            out = self.whole(word.decode())
        self[word] = out
        return out

    def part(self, part: str) -> bytes:
        ids = self.parts.get(part)
        if ids is None:
            ids = self.parts[part] = b"".join([t.id.to_bytes(4, "little") for t in self.model.tokenize(part)])
        return ids

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def ids(self, text: str | None) -> bytes:
        raw = (text or "").encode().lower()
        if b"<|" in raw:  # may spell a special token, which the tokenizer finds before anything else
            return self.whole(text)
        if len(self) > REMEMBERED:
            self.older = dict(self)
            self.clear()
            self.parts.clear()
        return b"".join(map(self.__getitem__, raw.split()))


def _words(path: str) -> Words:
    if path not in _loaded:
        _loaded[path] = Words(path)
    return _loaded[path]


def pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, task, nth[, ids]): every document's ids and end token, cut at the capacity; nth counts the task's pieces of this length from 0."""
    names = ["doc_id", "piece", "start", "length", "ids_crc32", "task", "nth", "ids"][: 7 + with_ids]
    types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary()]
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, task int, nth long" + ", ids binary" * with_ids

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, end, step = _words(tokenizer_path), END.to_bytes(4, "little"), 4 * capacity
        task, seen = TaskContext.get().partitionId(), [0] * (capacity + 1)
        for batch in batches:
            rows: list[list] = [[] for _ in names]
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = words.ids(text.as_py()) + end
                for n, at in enumerate(range(0, len(ids), step)):
                    part = ids[at : at + step]
                    length = len(part) // 4
                    for column, value in zip(rows, (doc, n, at // 4, length, zlib.crc32(part), task, seen[length], part), strict=False):
                        column.append(value)
                    seen[length] += 1
            yield pa.RecordBatch.from_arrays([pa.array(r, t) for r, t in zip(rows, types, strict=False)], names)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(cut, schema)


class Tightest:
    """Segment tree over the remaining capacities 0..capacity: how many runs of open sequences have each."""

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.size)

    def add(self, capacity: int, n: int) -> None:
        i, count = capacity + self.size, self.count
        while i:
            count[i] += n
            i >>= 1

    def find(self, least: int) -> int:
        """The smallest remaining capacity of open sequences that is at least `least`, or -1."""
        i, count, size = least + self.size, self.count, self.size
        if count[i]:
            return least
        while i > 1:
            if not i & 1 and count[i + 1]:
                i += 1
                while i < size:
                    i = 2 * i if count[2 * i] else 2 * i + 1
                return i - size
            i >>= 1
        return -1


def best_fit_decreasing(counts: dict[int, int], capacity: int) -> np.ndarray:
    """Best-fit decreasing of counts[n] pieces of each length n. Rows (length, rank, sequence, each, offset), by length and rank.

    The pieces of a length from `rank` on, up to the next row's, go to the sequences from `sequence` on, `each` of them to one, the
    first of these at `offset`. Any sequence of the tightest room takes as many pieces of a length as fit before the next one does.
    """
    tree, open_at, opened, plan = Tightest(capacity), [[] for _ in range(capacity + 1)], 0, []

    def leave(first: int, many: int, room: int) -> None:
        if many and room:
            open_at[room].append((first, many))
            tree.add(room, 1)

    for n in sorted(counts, reverse=True):
        left, rank = counts[n], 0
        while left:
            room = tree.find(n)
            if room < 0:
                room, each = capacity, capacity // n
                first, many = opened, -(-left // each)
                opened += many
            else:
                first, many = open_at[room].pop()
                tree.add(room, -1)
                each = room // n
            plan.append((n, rank, first, each, capacity - room))
            full = min(many, left // each)
            leave(first, full, room - each * n)
            rank, left = rank + full * each, left - full * each
            if left and full < many:
                leave(first + full, 1, room - left * n)
                full, left = full + 1, 0
            leave(first + full, many - full, room)
    return np.array(sorted(plan), np.int64).reshape(-1, 5)


def placed(plan: np.ndarray, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and offset of pieces, given their lengths and their ranks among the pieces of the same length."""
    row = np.empty(len(length), np.int64)
    for n in np.unique(length):
        mine = length == n
        a, b = np.searchsorted(plan[:, 0], [n, n + 1])
        row[mine] = a + np.searchsorted(plan[a:b, 1], rank[mine], "right") - 1
    _, begin, sequence, each, offset = plan[row].T
    past = rank - begin
    return sequence + past // each, offset + past % each * length


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    importable(docs.sparkSession)
    table = Scratch(docs.sparkSession).write(pieces(docs, tokenizer_path, capacity))
    # at most one row for each length up to the capacity
    plan = best_fit_decreasing({r["length"]: r["n"] for r in table.groupBy("length").agg(F.count("*").alias("n")).collect()}, capacity)
    earlier = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    tasks = table.groupBy("task", "length").agg(F.count("*").alias("n"))
    tasks = tasks.select("task", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    kept = ["doc_id", "piece", "start", "length", "ids_crc32"]
    ranked = table.join(tasks, ["task", "length"]).select(*kept, (F.col("before") + F.col("nth")).alias("rank"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            where = placed(plan, *(batch.column(c).to_numpy(zero_copy_only=False) for c in (3, 5)))
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], *map(pa.array, where)], [*kept, "sequence_id", "offset"])

    return ranked.mapInArrow(place, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
