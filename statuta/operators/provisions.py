"""What amending acts and rulings do to the units of other acts, and whether a text of an act has it.

Texts are read by folds over a few kinds of marks (quotation marks, clauses of a ruling), each a small function over one text that runs in Arrow
batches. What they find becomes rows whose units are compared by an order of labels, so that an unexpanded range is an interval and a question
about an article is an equi-join on cells of that order.

A null text gives empty results. Positions are code points from 0.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.identifiers import SPACE, TEXT_UNIT_LIST, UNIT_LIST, plain_numbers, plain_numbers_of, units_of

OPENING, CLOSING = "„", "”“"
#: A quotation of more characters has lost its closing mark.
LONGEST = 200_000


def _mask(text: str, longest: int) -> tuple[str, str, list[tuple[int, int]], int]:
    """(text with quotations blank, text with all else blank, uncertain spans, depth at the end), by one pass over the marks."""
    spans, unsure, depth, start = [], [], 0, 0
    for mark in re.finditer(f"[{OPENING}{CLOSING}]", text):
        at = mark.start()
        if depth and at - start > longest:
            # closed nowhere near: what was masked up to the limit stays so, the rest is read, and all of it is doubtful
            spans.append((start, start + longest + 1))
            unsure.append((start, start + longest + 1))
            depth = 0
        if mark.group() in OPENING:
            start = start if depth else at
            depth += 1
        elif depth:
            depth -= 1
            if not depth:
                spans.append((start, at + 1))
    if depth:
        end = min(len(text), start + longest + 1)
        spans.append((start, end))
        unsure.append((start, end if end < len(text) else len(text)))
        depth = 0 if end < len(text) else depth
    outside, inside, at = [], [], 0
    blank = lambda s: "\n".join([" " * len(line) for line in s.split("\n")])
    for a, b in spans:
        outside += [text[at:a], blank(text[a:b])]
        inside += [blank(text[at:a]), text[a:b]]
        at = b
    return "".join([*outside, text[at:]]), "".join([*inside, blank(text[at:])]), unsure, depth


def quotations(text: Column, longest: int = LONGEST) -> Column:
    """X-07, W-06: struct(masked, quoted, unsure, depth). masked: text with each quotation, nested ones in it, as blanks of its length (line ends stay);
    quoted: the quotations alone, all else blank; unsure: spans (s, e) where a closing mark is missing, so nothing may be concluded from what was
    not found there; depth: marks still open at the end. A closing mark without an opening one is an ordinary character."""

    def fold(texts: pa.Array) -> pa.Array:
        found = [_mask(t.as_py() or "", longest) for t in texts]
        unsure = pa.array([[{"s": a, "e": b} for a, b in f[2]] for f in found], pa.list_(pa.struct([("s", pa.int64()), ("e", pa.int64())])))
        columns = [pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.string()), unsure, pa.array([f[3] for f in found], pa.int32())]
        return pa.StructArray.from_arrays(columns, ["masked", "quoted", "unsure", "depth"])

    fold.__annotations__ = {"texts": pa.Array, "return": pa.Array}
    return F.arrow_udf(fold, "masked string, quoted string, unsure array<struct<s: long, e: long>>, depth int")(text)


#: A list of articles, with the word before it; a list behind 'po' is dropped with its own articles only.
_NAMED = re.compile(rf"(\b[pP][oO]{SPACE}+)?\b[aA][rR][tT]\.{SPACE}*({TEXT_UNIT_LIST})")
_HEADING = re.compile(rf"(?:^|(?<=[\n\r\x85\u2028\u2029]))[ \t{OPENING}]*Art\.{SPACE}*([0-9]+[a-z]*(?:\x20[0-9]+[a-z]*)*)\.")
_WHOLE = re.compile(
    rf"(?i)w{SPACE}+całej{SPACE}+ustawie|uchyla{SPACE}+się{SPACE}+(?:rozdział|dział|oddział|tytuł|księg|część)|(?:rozdział|dział|oddział|tytuł){SPACE}+(?-i:[A-Za-z0-9_]+){SPACE}+otrzymuje{SPACE}+brzmienie"
)


def _changed(text: str) -> tuple[list[str], list[str], bool, bool]:
    """(keys, ranges, whole, unsure) of one text."""
    outside, inside, unsure, _ = _mask(text, LONGEST)
    outside = plain_numbers_of(outside)
    lists = [m[2] for m in _NAMED.finditer(outside) if m[1] is None]
    if "Art." in inside:
        lists += _HEADING.findall(plain_numbers_of(inside))
    keys, ranges = set(), set()
    for said in lists:
        more, spans = units_of(said)
        keys |= more
        ranges.update(spans)
    return sorted(keys), sorted(ranges), _WHOLE.search(outside) is not None, bool(unsure)


def changed_units(text: Column) -> Column:
    """X-08: struct(keys, ranges, whole, unsure) of the articles that an amending act's text changes, repeals or adds.

    keys: articles named in lists outside quotations, and the headings of articles that quotations bring; an article behind the word for "after"
    is only the place of an insertion. ranges: 'from..to' that cannot be spelled out. whole: the act as a whole, or a division without its
    articles, is changed. unsure: a quotation is not closed. A text is read once, by one fold.
    """

    def fold(texts: pa.Array) -> pa.Array:
        columns = list(zip(*[_changed(t.as_py() or "") for t in texts], strict=True)) or [[]] * 4
        types = [pa.list_(pa.string()), pa.list_(pa.string()), pa.bool_(), pa.bool_()]
        return pa.StructArray.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["keys", "ranges", "whole", "unsure"])

    fold.__annotations__ = {"texts": pa.Array, "return": pa.Array}
    return F.arrow_udf(fold, "keys array<string>, ranges array<string>, whole boolean, unsure boolean")(text)


_NUMBER = r"(?:[IVX]+\.?|\d+[.)]|[a-z]\))"
#: What a ruling's operative part is made of, as kinds of tokens. A subject begins with a capital or a section mark at the start of a clause.
_TOKENS = re.compile(
    rf"""(?P<subject>(?:(?:^|(?<=[:;.])\s*)(?:{_NUMBER}\s+)?|(?<=\s){_NUMBER}\s+)(?P<mark>Art\.|§)\s*(?P<units>{UNIT_LIST}))
    |(?P<order>(?<!\S)(?:[IVX]+\.?|\d+[.)])\s+(?=Przepis))
    |(?P<back>(?i:(?:ustawy|rozporządzenia|kodeksu|przepis\w*)\s+(?:powołan\w+|wymienion\w+|wskazan\w+)\s+w\s+(?:pkt|punkcie|części)\s+(?P<point>[IVX]+|\d+)|te(?:j|jże|go)\s+(?:ustawy|rozporządzenia|kodeksu)))
    |(?P<act>(?:ustawy|rozporządzenia|kodeksu|Kodeksu|dekretu|uchwały)\s+(?:(?!\s(?:jest|są|nie|w\s+zakresie|w\s+części|w\s+brzmieniu|rozumian)\b).)*?)(?=\s*(?:\(|,|:|\s(?:jest|są|nie|traci|w\s+zakresie|w\s+części|w\s+brzmieniu|rozumian)\b|$))
    |(?P<scope>(?i:w\s+zakresie|rozumian\w+|przez\s+to,?\s+że|pomija|w\s+części,?\s+(?:w\s+jakiej|w\s+której|dotycz\w+|obejmuj\w+)))
    |(?P<part>(?:ust\.|§|pkt|zdani\w+|lit\.)\s*\w+)
    |(?P<verdict>(?i:\b(?P<negated>nie\s+)?(?:jest|są)\s+(?P<void>nie\s*-?\s*)?zgodn\w*|\btra(?:ci|cą)\s+moc))""",
    re.VERBOSE,
)
_ROMAN = {"I": 1, "V": 5, "X": 10}


def _number(s: str) -> int:
    if s.isdigit():
        return int(s)
    values = [_ROMAN[c] for c in s]
    return sum(-v if v < max(values[i:]) else v for i, v in enumerate(values))


def _operative(text: str) -> list[dict]:
    """Points of an operative part, by a fold over its tokens; the state is the point that is open."""
    body = re.search(r"(?is)\borzeka\s*:?(.*)", " ".join(text.split()))
    body = re.split(r"(?i)Ponadto\s+postanawia|\bpostanawia\s*:|Orzeczenie\s+zapadło|Poświadczono|Uzasadnienie|Zdanie\s+odrębne", body.group(1) if body else " ".join(text.split()), maxsplit=1)[0].strip()
    points: list[dict] = []
    for token in _TOKENS.finditer(body):
        kind = next(k for k in ("subject", "order", "back", "act", "scope", "part", "verdict") if token.group(k) is not None)
        now = points[-1] if points else None
        if kind in ("subject", "order"):
            units = token.group("units") if kind == "subject" else None
            points.append({"mark": "" if units is None else token.group("mark"), "units": units or "", "act": None, "said": [], "limited": False, "partly": False})
            continue
        if now is None:
            continue
        if kind == "verdict":
            # "is contrary" voids; "is not contrary" and "conforms" do not
            void = token.group("void") is not None and token.group("negated") is None or token.group().lower().startswith("tra")
            now["said"].append("void" if void else "valid")
        elif kind == "scope":
            now["limited"] = True
        elif now["said"]:
            continue  # behind a verdict stand the patterns of review, which are no subjects
        elif kind == "part":
            now["partly"] = now["partly"] or now["act"] is None
        elif kind == "act":
            now["act"] = now["act"] or token.group("act").strip()
        elif kind == "back" and now["act"] is None:
            at = _number(token.group("point")) - 1 if token.group("point") else len(points) - 2
            before = points[at] if 0 <= at < len(points) - 1 else None
            now["act"] = before["act"] if before else None
            if not now["units"] and before:
                now.update(mark=before["mark"], units=before["units"], partly=before["partly"])
    for i, p in enumerate(points):
        p["point"] = i + 1
        p["verdict"] = "void" if "void" in p["said"] else "valid" if p["said"] else "unknown"
        keys, p["ranges"] = units_of(p["units"])
        p["keys"] = sorted(keys)
    return points


def operative_part(text: Column) -> Column:
    """X-09: array of (point, mark, keys, ranges, act, verdict, limited, partly): what a ruling decides of which units.

    Subjects begin a clause with 'Art.' or '§'; articles in small letters behind the verdict are the patterns of review. A point that goes back to
    "the act named in point n" has that point's act, and its units where it names none itself. verdict: void if any verdict of the point is, valid
    if all are ("is not contrary" is valid), unknown without one. limited: only in some scope or reading; partly: some part of the unit.
    """
    texts, booleans = pa.list_(pa.string()), pa.bool_()
    fields = [("point", pa.int32()), ("mark", pa.string()), ("keys", texts), ("ranges", texts), ("act", pa.string()), ("verdict", pa.string()), ("limited", booleans), ("partly", booleans)]
    schema = "array<struct<point: int, mark: string, keys: array<string>, ranges: array<string>, act: string, verdict: string, limited: boolean, partly: boolean>>"

    def fold(texts: pa.Array) -> pa.Array:
        return pa.array([[{n: p[n] for n, _ in fields} for p in _operative(t.as_py() or "")] for t in texts], pa.list_(pa.struct(fields)))

    fold.__annotations__ = {"texts": pa.Array, "return": pa.Array}
    return F.arrow_udf(fold, schema)(plain_numbers(text))


def unit_order(key: Column) -> Column:
    """J-12: the key of a unit as text that sorts as units stand in an act: 4 < 4^1 < 4^1a < 4^2 < 4a < 5 < 479^88a < 479^88b < 480. Null for no unit."""
    part = lambda s, pattern, i: F.regexp_extract(s, pattern, i)
    pattern = r"^(\d+)([a-z]*)(?:\^(\d+)([a-z]*))?$"
    low = F.lower(key)
    number = lambda i: F.lpad(F.regexp_replace(part(low, pattern, i), "^0+(?=.)", ""), 9, "0")
    whole = F.concat(number(1), F.rpad(part(low, pattern, 2), 6, " "), number(3), part(low, pattern, 4))
    # most keys are plain numbers, which need no pattern
    plain = key.isNotNull() & F.char_length(key).between(1, 9) & (F.translate(key, "0123456789", "") == "")
    return F.when(plain, F.concat(F.lpad(key, 9, "0"), F.lit(" " * 6 + "0" * 9))).when(low.rlike(pattern), whole)


def unit_number(key: Column) -> Column:
    """The number at the front of a key."""
    return F.regexp_extract(key, r"^(\d+)", 1).try_cast("long")


#: Units whose numbers share a cell of the interval join.
CELL = 16
#: What a row of currency() is: an article asked for, or a change that names one, or a range, or none that is known.
ASKED, NAMED, RANGE, VAGUE = range(4)


def within_ranges(asked: DataFrame, ranges: DataFrame, on: list[str], cell: int = CELL) -> DataFrame:
    """J-12: asked (on..., article) joined with the ranges (on..., low, high) that hold the article, both ends included.

    A range is dealt to the cells of numbers that it covers, so the join is on equality of `on` and cell; the order of labels decides the rest.
    """
    dealt = ranges.withColumn("_cell", F.explode(F.sequence(F.floor(unit_number(F.col("low")) / cell), F.floor(F.greatest(unit_number(F.col("low")), unit_number(F.col("high"))) / cell))))
    dealt = dealt.select(*on, "_cell", *[c for c in ranges.columns if c not in on])
    rows = asked.withColumn("_cell", F.floor(unit_number(F.col("article")) / cell))
    return rows.join(dealt, [*on, "_cell"]).where((unit_order(F.col("article")) >= unit_order(F.col("low"))) & (unit_order(F.col("article")) <= unit_order(F.col("high")))).drop("_cell")


def _cell_of(key: Column, cell: int) -> Column:
    """The cell of a unit's number, -1 without one."""
    return F.coalesce(F.floor(unit_number(key) / cell), F.lit(-1))


def _dealt(lacking: DataFrame, cell: int) -> DataFrame:
    """(act, kind, _cell, article, low, high, amendment, later): changes, in the cells of numbers that they cover; low and high as orders."""
    vague = F.coalesce(F.col("whole") | F.col("unsure"), F.lit(False))
    kind = F.when(F.col("article").isNotNull(), NAMED).when(F.col("low").isNotNull() & F.col("high").isNotNull(), RANGE)
    rows = lacking.where("act is not null").withColumn("_kind", kind).withColumn("_from", _cell_of(F.coalesce("article", "low"), cell))
    part = lambda kind, at: F.struct(kind.alias("kind"), at.cast("long").alias("_cell"))
    covered = F.sequence("_from", F.greatest("_from", _cell_of(F.col("high"), cell)))
    found = F.when(F.col("_kind") == NAMED, F.array(part(F.lit(NAMED), F.col("_from")))).when(F.col("_kind") == RANGE, F.transform(covered, lambda at: part(F.lit(RANGE), at)))
    found = F.coalesce(found, F.array().cast("array<struct<kind: int, _cell: bigint>>"))
    parts = F.when(vague, F.concat(found, F.array(part(F.lit(VAGUE), F.lit(-2))))).otherwise(found)
    rows = rows.select("act", F.explode(parts).alias("_p"), "article", "low", "high", "amendment", "later")
    named, order = F.when(F.col("_p.kind") == NAMED, F.col("article")), lambda c: F.when(F.col("_p.kind") == RANGE, unit_order(F.col(c))).alias(c)
    return rows.select("act", "_p.kind", "_p._cell", named.alias("article"), order("low"), order("high"), "amendment", "later")


def currency(asked: DataFrame, changes: DataFrame, contained: DataFrame | None, checked: DataFrame, day: Column, cell: int = CELL) -> DataFrame:
    """V-02: whether the text of an article is current on a day.

    asked (act, article); changes (act, amendment, article, low, high, whole, unsure, entry): one named article, or a range, or the whole act, or a
    change whose articles are not known; entry: the day it enters into force, null if unknown, which counts as in force. contained (act, amendment):
    changes that the text has, None where changes are without them. checked (act): acts whose list of changes is complete.

    (act, article, verdict, now, later): CHANGED by an amendment in force that the text lacks and that names the article or a range with it; UNSURE
    if a change of the whole act or one that could not be read is in force, or the act is not checked; PENDING if such changes enter into force
    later; else CURRENT. now, later: the number of amendments that name it.

    Changes are read once. They and the articles asked for are shuffled to their act, where both meet by cells of numbers; an act is one task's work, which
    spills, and holds no more than the articles asked for in one cell.
    """
    lacking = changes if contained is None else changes.join(contained, ["act", "amendment"], "left_anti")
    dealt = _dealt(lacking.withColumn("later", F.coalesce(F.col("entry") > day, F.lit(False))), cell)
    rows = asked.select("act", F.lit(ASKED).alias("kind"), _cell_of(F.col("article"), cell).alias("_cell"), "article").unionByName(dealt, allowMissingColumns=True).repartition("act")
    kind, article = F.col("kind"), F.array("article")
    held = F.collect_set(F.when(kind == ASKED, F.col("article"))).over(Window.partitionBy("act", "_cell"))
    meets = F.when(kind == RANGE, F.col("_held")).when((kind != NAMED) | F.array_contains("_held", F.col("article")), article)
    met = rows.withColumn("_held", held).select("act", "kind", F.explode(meets).alias("article"), "low", "high", "amendment", "later")
    met = met.where((kind != RANGE) | unit_order(F.col("article")).between(F.col("low"), F.col("high")))
    vague = (kind == VAGUE).alias("_vague")
    each = met.groupBy("act", "article", vague, "amendment").agg(F.bool_or(~F.col("later")).alias("_now"), F.bool_or("later").alias("_later"))
    count = lambda c, name: F.count(F.when(F.col(c), F.col("amendment"))).alias(name)
    told = each.groupBy("act", "article", "_vague").agg(count("_now", "now"), count("_later", "later"), F.bool_or("_now").alias("_now"), F.bool_or("_later").alias("_later"))
    # what changes say of no known article is told to all of their act
    of_act = lambda c: F.coalesce(F.bool_or(F.col("_vague") & F.col(c)).over(Window.partitionBy("act")), F.lit(False))
    told = told.select("act", "article", "now", "later", "_vague", of_act("_now").alias("vague"), of_act("_later").alias("vague_later")).where("not _vague")
    out = told.join(checked.select("act").distinct().withColumn("known", F.lit(True)), "act", "left")
    verdict = (
        F.when(F.col("now") > 0, "CHANGED").when(F.col("vague") | F.col("known").isNull(), "UNSURE")
        .when((F.col("later") > 0) | F.col("vague_later"), "PENDING").otherwise("CURRENT")
    )
    return out.select("act", "article", verdict.alias("verdict"), "now", "later")


def change_rows(acts: DataFrame, text: Column) -> DataFrame:
    """acts plus one row for each article, range or whole-act change that text makes: article, low, high, whole, unsure. An act whose text names
    nothing gives one row without them that is unsure."""
    fields = [("article", pa.string()), ("low", pa.string()), ("high", pa.string()), ("whole", pa.bool_()), ("unsure", pa.bool_())]
    row = lambda article=None, low=None, high=None, whole=False, unsure=False: dict(article=article, low=low, high=high, whole=whole, unsure=unsure)

    def rows(said: str) -> list[dict]:
        keys, ranges, whole, unsure = _changed(said)
        out = [row(article=k) for k in keys]
        for r in ranges:
            low, high = r.split("..")
            out.append(row(low=low, high=high))
        if whole:
            out.append(row(whole=True))
        if unsure or not out:
            out.append(row(unsure=True))
        return out

    def fold(texts: pa.Array) -> pa.Array:
        # equal texts of a batch are read once
        said = texts.dictionary_encode(null_encoding="encode")
        return pa.array([rows(t or "") for t in said.dictionary.to_pylist()], pa.list_(pa.struct(fields))).take(said.indices)

    fold.__annotations__ = {"texts": pa.Array, "return": pa.Array}
    # exploded where it is made: a column of its own would be made again for the filter that Spark infers from explode
    made = F.arrow_udf(fold, "array<struct<article: string, low: string, high: string, whole: boolean, unsure: boolean>>")
    return acts.select(*acts.columns, F.explode(made(text)).alias("_r")).select(*acts.columns, "_r.*")
