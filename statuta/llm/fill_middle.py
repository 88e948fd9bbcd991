"""Operator 11: fill-in-the-middle transformation over an index of distinct texts.

Identical texts are grouped once: rows meet by the SHA-256 of their text and each group compares the texts themselves. For each group the
ends of its lines (code points) are written once as an Elias-Fano list: low bits packed, high bits in unary, about two bits and the logarithm
of the mean line for a line. Documents, which are rows of a few numbers there, join the index by that key; two selects in the list give the
places of a seeded cut. A text is shuffled once for each distinct text of a map task; nothing else that travels grows with texts.

Groups of many copies are dealt into shares: keys that more than max(GROUP, rows / HOT_KEYS) rows have are fewer than HOT_KEYS, so the table
of them is broadcast, and a share holds about that many rows.

Edge cases: a null text is an empty one; empty texts have no line and stay plain, as do texts that hold one of the three marks; a null doc_id
takes the seed of the word null; rows that repeat a doc_id each get a row; a text of one line has cuts at its ends only; an empty table gives
an empty result; other columns are ignored. A group whose texts differ (a collision of SHA-256) stops the job rather than mixing them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import Scratch, importable

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Rows of one text that meet in one task, about, and the number of texts that can have more.
GROUP, HOT_KEYS = 128, 200_000


def encode(ends: np.ndarray) -> tuple[bytes, bytes]:
    """Elias-Fano list of rising integers: (low bits, high bits). The width of the low bits follows from their number and the last."""
    n = len(ends)
    if not n:
        return b"", b""
    width, ends = low_width(n, int(ends[-1])), ends.astype(np.int64)
    low = (ends[:, None] >> np.arange(width)) & 1
    high = np.zeros(n + (int(ends[-1]) >> width) + 1, np.uint8)
    high[(ends >> width) + np.arange(n)] = 1
    return np.packbits(low.astype(np.uint8).ravel(), bitorder="little").tobytes(), np.packbits(high, bitorder="little").tobytes()


def low_width(n: int, last: int) -> int:
    return max(0, (last // n).bit_length() - 1)


def select(low: bytes, high: bytes, n: int, last: int, k: int) -> int:
    """The k-th number of the list, from 0: where the k-th set bit of the high part is, and the k-th low part."""
    ones = np.cumsum(np.bitwise_count(np.frombuffer(high, np.uint8)), dtype=np.int64)
    byte = int(np.searchsorted(ones, k, side="right"))
    bit = int(np.flatnonzero(np.unpackbits(np.frombuffer(high, np.uint8, 1, byte), bitorder="little"))[k - (int(ones[byte - 1]) if byte else 0)])
    width = low_width(n, last)
    first = k * width
    part = int.from_bytes(low[first // 8 : (first + width + 7) // 8], "little") >> first % 8
    return (8 * byte + bit - k << width) | (part & ((1 << width) - 1))


def line_ends(texts: pa.Array) -> Iterator[np.ndarray]:
    """For each text the places, in code points, at which its lines end; a line takes its line feed with it."""
    texts = texts.cast(pa.large_string())
    at = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, 8 * texts.offset)
    data = np.frombuffer(texts.buffers()[2], np.uint8) if at[-1] > at[0] else np.zeros(0, np.uint8)
    for a, b in zip(at[:-1], at[1:], strict=True):
        raw = data[a:b]
        ends = np.flatnonzero(raw == 0x0A) + 1
        if len(raw) and (not len(ends) or ends[-1] != len(raw)):
            ends = np.append(ends, len(raw))
        inner = np.flatnonzero((raw & 0xC0) == 0x80)  # bytes that continue a character
        yield ends - np.searchsorted(inner, ends)


def _boundaries(texts: pa.Array) -> pa.Array:
    n, chars, low, high = [], [], [], []
    for ends in line_ends(texts):
        a, b = encode(ends)
        n.append(len(ends))
        chars.append(int(ends[-1]) if len(ends) else 0)
        low.append(a)
        high.append(b)
    return pa.StructArray.from_arrays([pa.array(n, pa.int64()), pa.array(chars, pa.int64()), pa.array(low, pa.binary()), pa.array(high, pa.binary())], ["n", "chars", "low", "high"])


def _cut(lists: pa.Array, i: pa.Array, j: pa.Array) -> pa.Array:
    n, chars, low, high = (pc.struct_field(lists, k).to_pylist() for k in ("n", "chars", "low", "high"))
    found = []
    for wanted in (i.to_pylist(), j.to_pylist()):
        found.append([0 if not k else last if k == size else select(lo, hi, size, last, k - 1) for k, size, last, lo, hi in zip(wanted, n, chars, low, high, strict=True)])
    return pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in found], ["a", "b"])


def distinct_texts(rows: DataFrame) -> DataFrame:
    """rows: (key, share, text), key being a digest of text. One row for each key and share, whose texts are seen to be equal."""
    # a set compares the texts themselves and keeps one of equal ones
    met = rows.groupBy("key", "share").agg(F.collect_set("text").alias("texts"))
    same = F.when(F.size("texts") == 1, F.col("texts")[0]).otherwise(F.raise_error(F.lit("two texts of one digest")))
    return met.select("key", "share", same.alias("text"))


def boundary_index(texts: DataFrame) -> DataFrame:
    """(key, share, lines): the line ends of each of distinct_texts() as an Elias-Fano list, with their number and the length of the text."""
    return texts.select("key", "share", F.arrow_udf(_boundaries, "n long, chars long, low binary, high binary")("text").alias("lines"))


def _seeds(doc_id: Column, seed: int) -> list[Column]:
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("null"))), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)]


def transform(docs: DataFrame, seed: int = 7, rate: int = 100, spm: int = 50, group: int = GROUP) -> DataFrame:
    """One row per document: doc_id, n (lines), form, prefix_chars, middle_chars, output.

    rate: documents in a hundred that are cut; spm: cut documents in a hundred that have their suffix first.
    """
    spark = docs.sparkSession
    importable(spark)
    text = F.coalesce("text", F.lit(""))
    hashed = docs.select(F.xxhash64(text).alias("h"))
    limit = max(group, docs.count() // HOT_KEYS)
    # fewer than rows / limit, so at most HOT_KEYS rows of two numbers
    hot = Scratch(spark).write(hashed.groupBy("h").agg(F.count("*").alias("n")).where(F.col("n") > limit).select("h", F.ceil(F.col("n") / limit).alias("shares")))
    rows = docs.select("doc_id", text.alias("text"), F.xxhash64(text).alias("h"), F.xxhash64(F.monotonically_increasing_id()).alias("u")).join(F.broadcast(hot), "h", "left")
    share = F.pmod("u", F.coalesce("shares", F.lit(1))).alias("share")
    key = F.unhex(F.sha2("text", 256)).alias("key")
    # two branches from one shuffle: the texts stay where it put them, and their lists, a hundredth of them, travel to the documents
    texts = distinct_texts(rows.select(key, share, "text"))
    h = _seeds(F.col("doc_id"), seed)
    marked = F.col("text") == ""
    for mark in (PREFIX, SUFFIX, MIDDLE):
        marked = marked | F.contains(F.col("text"), F.lit(mark))
    form = F.when(marked | (h[2] % 100 >= rate), "plain").when(h[3] % 100 < spm, "spm").otherwise("psm")
    asked = rows.select("doc_id", key, share, h[0].alias("h1"), h[1].alias("h2"), form.alias("form"))
    units = F.col("lines.n") + 1
    one, two = F.pmod(F.col("h1"), units), F.pmod(F.col("h2"), units)
    placed = asked.join(boundary_index(texts), ["key", "share"], "left").withColumn("at", F.arrow_udf(_cut, "a long, b long")("lines", F.least(one, two), F.greatest(one, two)))
    placed = placed.select("key", "share", "doc_id", "form", F.col("lines.n").alias("n"), F.col("lines.chars").alias("chars"), F.col("at.a").alias("a"), F.col("at.b").alias("b"))
    cut = placed.join(texts, ["key", "share"], "left").withColumn("text", F.coalesce("text", F.raise_error(F.lit("a text left the table between two reads"))))
    piece = lambda start, end: F.substring("text", (start + 1).cast("int"), (end - start).cast("int"))
    cut = cut.select(
        "doc_id", "n", "form", "a", (F.col("b") - F.col("a")).alias("m"), "text", piece(F.lit(0), F.col("a")).alias("prefix"),
        piece(F.col("a"), F.col("b")).alias("middle"), piece(F.col("b"), F.col("chars")).alias("suffix"),
    )
    psm = F.concat(F.lit(PREFIX), "prefix", F.lit(SUFFIX), "suffix", F.lit(MIDDLE), "middle")
    swapped = F.concat(F.lit(SUFFIX), "suffix", F.lit(PREFIX), "prefix", F.lit(MIDDLE), "middle")
    output = F.when(F.col("form") == "plain", F.col("text")).when(F.col("form") == "psm", psm).otherwise(swapped)
    cut_only = lambda c: F.when(F.col("form") != "plain", F.col(c))
    return cut.select("doc_id", "n", "form", cut_only("a").alias("prefix_chars"), cut_only("m").alias("middle_chars"), output.alias("output"))


def restore(output: Column, form: Column) -> Column:
    """The text that an output was made of, from output and form alone: a cut text holds no mark, so the marks split it in place."""
    part = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}")
    at = lambda *order: F.concat(*[F.try_element_at(part, F.lit(k)) for k in order])
    return F.when(form == "psm", at(2, 4, 3)).when(form == "spm", at(3, 4, 2)).otherwise(output)


def digests(docs: DataFrame, **options) -> DataFrame:
    """One row per document: doc_id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256."""
    made = transform(docs, **options)
    return made.select(*made.columns[:-1], F.sha2("output", 256).alias("output_sha256"), F.sha2(restore(F.col("output"), F.col("form")), 256).alias("restored_sha256"))
