"""Passages of texts: keyword windows, units between headings, paragraphs, footnotes, quotations. Spans are [start, end) from 0."""

from __future__ import annotations

import re
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.identifiers import SPACE, TEXT_UNIT_LIST, article_key, plain_numbers, unit_key, units_of


def keyword_windows(docs: DataFrame, key: str, text: Column, phrase: str, width: int = 600, most: int = 6) -> DataFrame:
    """X-02, W-05: (key, i, s, e, hits): merged windows around the hits of a phrase: a third of the width before, the width behind; the first `most` of each text.

    Hits are case-insensitive and do not overlap. A text with the phrase is read once, in its row, up to the end of its last window; nothing is shuffled.
    """
    p = phrase.lower()

    def windows(texts: pa.Array, lengths: pa.Array) -> pa.Array:
        out = []
        for said, n in zip(texts, lengths.to_pylist(), strict=True):
            low, found = said.as_py(), []
            at = low.find(p)
            while at >= 0:
                s, e = max(0, at - width // 3), min(n, at + len(p) + width)
                if found and s <= found[-1]["e"]:
                    found[-1]["e"] = max(found[-1]["e"], e)
                    found[-1]["hits"] += 1
                elif len(found) == most:
                    break
                else:
                    found.append({"s": s, "e": e, "hits": 1})
                at = low.find(p, at + len(p))
            out.append(found)
        return pa.array(out, pa.list_(pa.struct([("s", pa.int64()), ("e", pa.int64()), ("hits", pa.int64())])))

    windows.__annotations__ = {"texts": pa.Array, "lengths": pa.Array, "return": pa.Array}
    low = F.lower(text)
    hit = docs.where(F.contains(low, F.lit(p))) if p.strip() else docs.where(F.lit(False))
    found = F.arrow_udf(windows, "array<struct<s: long, e: long, hits: long>>")(low, F.char_length(text).cast("long"))
    return hit.select(key, F.posexplode(found).alias("i", "w")).select(key, (F.col("i") + 1).alias("i"), "w.*")


def snapped(text: Column, start: Column, end: Column, reach: int = 120) -> Column:
    """X-03: a span with its edges moved out to the sentence end, line end or word edge within reach: struct(s, e)."""
    before = F.substring(text, F.greatest(start - reach, F.lit(0)).cast("int") + 1, (start - F.greatest(start - reach, F.lit(0))).cast("int"))
    after = F.substring(text, end.cast("int") + 1, reach)
    tail = F.coalesce(*[F.when(before.rlike(p), F.char_length(F.regexp_extract(before, p, 1))) for p in (r"(?s)[.!?]\s+((?:(?![.!?]\s).)*)$", r"(?s)\n([^\n]*)$", r"(?s)\s(\S*)$")], F.lit(0))
    head = F.coalesce(*[F.when(after.rlike(p), F.char_length(F.regexp_extract(after, p, 1))) for p in (r"(?s)^(.*?[.!?])(?:\s|$)", r"(?s)^([^\n]*)\n", r"(?s)^(\S*)\s")], F.lit(0))
    whole = lambda: F.when(start <= reach, start)
    return F.struct((start - F.coalesce(F.when(tail > 0, tail), F.when(start <= reach, whole()), F.lit(0))).cast("long").alias("s"), (end + head).cast("long").alias("e"))


def _starts(lengths: pa.Array) -> pa.Array:
    """Running sums of each list, without the last."""
    at = lengths.offsets.to_numpy()
    flat = lengths.values.to_numpy()[at[0] : at[-1]]
    sums = np.concatenate([[0], np.cumsum(flat, dtype=np.int64)])
    starts = sums[:-1] - np.repeat(sums[at[:-1] - at[0]], np.diff(at))
    return pa.ListArray.from_arrays(pa.array(at - at[0], pa.int32()), pa.array(starts), mask=lengths.is_null() if lengths.null_count else None)


def lines(docs: DataFrame, key: str, text: Column) -> DataFrame:
    """(key, line_no, s, line, n): each line with its offset and the length of its text, all made in the text's own row."""
    parts = F.split(text, "\n")
    rows = docs.select(key, parts.alias("_lines"), F.char_length(text).cast("long").alias("n"))
    starts = F.arrow_udf(_starts, "array<long>")(F.transform("_lines", lambda x: F.char_length(x) + 1))
    rows = rows.withColumn("_starts", starts).select(key, "n", F.posexplode(F.arrays_zip("_lines", "_starts")).alias("line_no", "x"))
    return rows.select(key, "line_no", F.col("x._starts").alias("s"), F.col("x._lines").alias("line"), "n")


def units(line_rows: DataFrame, key: str, heading: Column) -> DataFrame:
    """X-04: from each heading line to the next one: (key, s, e, heading); e of the last unit is the end of the text. Only headings are shuffled."""
    following = F.lead("s").over(Window.partitionBy(key).orderBy("line_no"))
    return line_rows.where(heading).select(key, "s", F.coalesce(following - 1, F.col("n")).alias("e"), F.col("line").alias("heading"))


def unit_texts(texts: DataFrame, key: str, asked: DataFrame) -> DataFrame:
    """X-04: texts (key, text) and asked (key, phrase): (key, article, s, e, text) of the units that the phrases name, from a heading to the next one.

    A heading begins a line outside quotations: 'Art. 5a.' or '§ 4.', with a footnote mark or an opening bracket or without; its number is compared
    as a key, so 5 is neither 5a nor 5 with a raised 1. A unit that stands in several places has a row for each.
    """
    from .provisions import quotations

    read = texts.select(key, F.col("text").alias("_text"), quotations(F.col("text"))["masked"].alias("_masked"))
    heading = r"^[\s\[<]*(?:Art\.|§)\s*(\d+[a-z]*(?:\x20\d+[a-z]*)*?)(?:\.|\x20?\d+\))"
    rows = lines(read, key, F.col("_masked"))
    found = units(rows, key, plain_numbers(F.col("line")).rlike(heading))
    number = unit_key(F.regexp_extract(plain_numbers(F.col("heading")), heading, 1))
    named = found.select(key, F.concat(F.when(F.col("heading").contains("§"), "§").otherwise(""), number).alias("article"), "s", "e")
    paragraph = F.concat(F.lit("§"), unit_key(F.regexp_extract("phrase", r"^\s*§\s*(\d+[a-z]*(?:\x20\d+[a-z]*)*)", 1)))
    wanted = asked.select(key, F.when(F.col("phrase").rlike(r"^\s*§"), paragraph).otherwise(article_key(F.col("phrase"))).alias("article")).where("article not in ('', '§')").distinct()
    hit = named.join(wanted, [key, "article"])
    return hit.join(read.select(key, "_text"), key).select(key, "article", "s", "e", F.substring("_text", (F.col("s") + 1).cast("int"), (F.col("e") - F.col("s")).cast("int")).alias("text"))


_CITED = re.compile(rf"\b[aA][rR][tT]\.{SPACE}*{TEXT_UNIT_LIST}|[dD][zZ]\.{SPACE}*[uU]\.[^()]*?[pP][oO][zZ]\.{SPACE}*[0-9]+")


def cited_provisions(text: Column, most: int = 40) -> Column:
    """S-17, S-21: array of (act, article): the first provisions that a judgment cites. Articles belong to the journal position that follows them; act is
    'year/position', null for articles that none follows."""
    def cited(text: str) -> list[dict]:
        out: dict[tuple, None] = {}
        open_: list[str] = []
        for token in _CITED.finditer(text):
            said = token.group()
            if not said.startswith("Dz"):
                open_ += sorted(units_of(said)[0])
                continue
            year, position = re.search(r"[0-9]{4}", said), re.search(rf"poz\.{SPACE}*([0-9]+)", said)
            act = "/".join([*([year[0]] if year else []), position[1] if position else ""])
            out.update(((act, article), None) for article in open_)
            open_ = []
        out.update(((None, article), None) for article in open_)
        return [{"act": act, "article": article} for act, article in islice(out, most)]

    def fold(texts: pa.Array) -> pa.Array:
        return pa.array([cited(t.as_py()) for t in texts], pa.list_(pa.struct([("act", pa.string()), ("article", pa.string())])))

    fold.__annotations__ = {"texts": pa.Array, "return": pa.Array}
    return F.arrow_udf(fold, "array<struct<act: string, article: string>>")(plain_numbers(F.coalesce(text, F.lit(""))))


def page_noise(page_lines: DataFrame, share: float = 0.6) -> DataFrame:
    """X-12: lines (doc, page, line_no, line) that are not text, with kind: watermark (one shape at one place on most pages), contents (dots and a page at
    the end), number (a bare page number)."""
    shape = F.regexp_replace(F.trim("line"), r"\d+", "#")
    alone = F.when(F.trim("line").rlike(r"(?i)^[-–— ]*(?:strona |str\. |s\. )?\d+[-–— ]*$"), "number").when(F.col("line").rlike(r"\.{5,}\s*\d+\s*$"), "contents")
    rows = page_lines.select("doc", "page", "line_no", F.nullif(shape, F.lit("")).alias("_shape"), alone.alias("_alone"))
    # distinct pages are counted as the first rows of each, so that all counts are windows over one shuffle by document
    first = lambda keys: (~F.lag("page").over(Window.partitionBy(*keys).orderBy("page")).eqNullSafe(F.col("page")) & F.col("page").isNotNull()).cast("int")
    place = ["doc", "line_no", "_shape"]
    rows = rows.withColumn("_p", first(["doc"])).withColumn("_pages", F.sum("_p").over(Window.partitionBy("doc")))
    rows = rows.withColumn("_s", first(place)).withColumn("_n", F.sum("_s").over(Window.partitionBy(*place)))
    often = F.col("doc").isNotNull() & F.col("line_no").isNotNull() & F.col("_shape").isNotNull() & (F.col("_pages") > 1) & (F.col("_n") >= share * F.col("_pages"))
    kind = F.coalesce(F.col("_alone"), F.when(often, "watermark"))
    return rows.select("doc", "page", "line_no", kind.alias("kind")).where("kind is not null")


def amounts_at_end(line_rows: DataFrame, key: str) -> DataFrame:
    """X-13: paragraphs() of lines whose amounts stand in a column of their own, from the fortieth character on: amounts go to the end of their paragraph."""
    column = r"^(.{37,}?\S) {3,}(\d[\d  ]*,\d{2})\s*$"
    apart = line_rows.withColumn("_amount", F.nullif(F.regexp_extract("line", column, 2), F.lit(""))).withColumn("line", F.regexp_replace("line", column, "$1"))
    bodies = paragraphs(apart, key)
    w = Window.partitionBy(key).orderBy("line_no")
    places = numbered_paragraphs(apart, key, w).where("_amount is not null").groupBy(key, "para").agg(F.array_sort(F.collect_list(F.struct("line_no", "_amount"))).alias("a"))
    return bodies.join(places, [key, "para"], "left").select(key, "para", "n_lines", F.concat_ws(" ", "text", F.array_join(F.transform("a", lambda x: x["_amount"]), " ")).alias("text"))


def numbered_paragraphs(line_rows: DataFrame, key: str, w) -> DataFrame:
    """line_rows plus para, the number of the paragraph that a line is in."""
    mark = r"^\s*(?:Art\.|§|Rozdział|\d+[.)]|[a-z]\))"
    new = (F.coalesce(F.lag(F.trim("line")).over(w), F.lit("")) == "") | F.col("line").rlike(r"^ {16}") | F.trim("line").rlike(r"\S {3,}\S") | F.col("line").rlike(mark)
    return line_rows.withColumn("_n", F.when(new, 1).otherwise(0)).withColumn("para", F.sum("_n").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))


def paragraphs(line_rows: DataFrame, key: str) -> DataFrame:
    """X-13: lines joined to paragraphs: a new one after a blank line, at deep indentation, at a table row or at a unit's mark."""
    marked = numbered_paragraphs(line_rows, key, Window.partitionBy(key).orderBy("line_no"))
    parts = marked.where(F.trim("line") != "").groupBy(key, "para").agg(F.array_sort(F.collect_list(F.struct("line_no", F.trim("line").alias("t")))).alias("p"))
    return parts.select(key, "para", F.size("p").alias("n_lines"), F.array_join(F.transform("p", lambda x: x["t"]), " ").alias("text"))


def page_furniture(page_lines: DataFrame, doc: str, page: str, line: Column, share: float = 0.6) -> DataFrame:
    """X-12: lines that most pages of a document have (headers, footers, watermarks), digits apart: (doc, line shape, pages)."""
    shape = F.regexp_replace(F.trim(line), r"\d+", "#")
    pages = page_lines.groupBy(doc).agg(F.count_distinct(page).alias("_pages"))
    seen = page_lines.where(F.trim(line) != "").select(doc, page, shape.alias("shape")).distinct().groupBy(doc, "shape").agg(F.count("*").alias("pages"))
    return seen.join(pages, doc).where((F.col("_pages") > 1) & (F.col("pages") >= share * F.col("_pages"))).drop("_pages")


def act_of_issue(line_rows: DataFrame, key: str, position: Column, wanted: int) -> DataFrame:
    """X-20: the lines of one act in an issue with several: from the line that is its position number to the next such line."""
    w = Window.partitionBy(key).orderBy("line_no").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return line_rows.withColumn("_act", F.last(position, ignorenulls=True).over(w)).where(F.col("_act") == wanted).drop("_act")


def footnotes(line_rows: DataFrame, key: str) -> DataFrame:
    """X-06: (key, note, text, refers): footnote lines 'N) text', the first of a number counts, with the notes they refer to."""
    note = F.regexp_extract("line", r"^\s*(?:\[przypis )?(\d{1,3})\)\]?\s+\S", 1)
    body = F.regexp_replace("line", r"^\s*(?:\[przypis )?\d{1,3}\)\]?\s+", "")
    rows = line_rows.where(note != "").select(key, note.cast("int").alias("note"), "line_no", body.alias("text"))
    first = rows.groupBy(key, "note").agg(F.min_by("text", "line_no").alias("text"))
    return first.withColumn("refers", F.transform(F.regexp_extract_all("text", F.lit(r"(?i)odnośnik\w*\s+(\d{1,3})")), lambda n: n.cast("int")))


def note_closure(notes: DataFrame, key: str, start: DataFrame, depth: int = 4) -> DataFrame:
    """X-06: notes reached from the start (key, note) by references, at most `depth` steps; visited notes are not followed again."""
    edges = notes.select(key, F.col("note").alias("_from"), F.explode("refers").alias("note"))
    reached = frontier = start.select(key, "note").distinct()
    for _ in range(depth):
        frontier = frontier.withColumnRenamed("note", "_from").join(edges, [key, "_from"]).select(key, "note").distinct().join(reached, [key, "note"], "left_anti")
        reached = reached.unionByName(frontier)
    return reached
