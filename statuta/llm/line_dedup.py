"""Operator 1: fuzzy deduplication of lines. DataFrame functions only.

A line is taken in lower case, without spaces around it. Its shingles are the nine characters from each start; a start is the first
character of a word (a run of U+0021 to U+0DFF), the ninth of one with nine to sixteen, every character of a longer one up to its last eight, and
each other character, as in scripts without spaces. So every character of a word lies in a shingle, any change of one changes the set, and one
that moves the rest of a long word changes the shingles around it alone. The MinHash signature is the twelve smallest hashes of the shingle set,
and each three neighbours in it are a band: two lines at the threshold share a band with a probability of about 0.98, and more similar lines
nearly always. Of four and five shingles the one that differs may break every band, so sets of five also have the hash of each subset that lacks
one shingle as keys, and those of four the hash of the set. Lines that share a key are verified by exact Jaccard similarity
(0.8) on their whole shingle sets, links are joined by distributed union-find, and of each component the first line (by doc_id, then
line number) stays.

Equal lines are one node, recognised by a 64-bit hash, and collapse before any band key is shuffled. Blank lines always stay.
With min_words, lines of fewer words stay too (headings, labels, closings), but none whose words have more than 16 characters on
average, as spaces do not tell their length; op1_line_dedup and the pipeline do without.

Edge cases: a null text counts as empty; an empty text is one empty line, which stays; a null doc_id ranks last; rows that repeat a
doc_id or have none are separate documents, the later of equal rows loses its lines; an empty table gives an empty result; lines of any length are
read whole; other columns, whatever their names, are ignored by decisions() and kept by dedup_lines().
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .buckets import linked_by_keys
from .shared import Scratch, let

SHINGLE = 9
SIGNATURE = 12
BAND = 3
#: min_words that takes every line that is not blank.
ALL = 0
#: At each start the shingle is captured; then a word's last eight characters or fewer are passed, or the first eight of nine to sixteen, or one.
_W, _SHORT = r"[!-\x{DFF}]", SHINGLE - 1
STARTS = rf"(?s)(?=(.{{1,{SHINGLE}}}))(?:{_W}{{1,{_SHORT}}}+(?!{_W})|(?<!{_W}){_W}{{{_SHORT}}}(?={_W}{{1,{_SHORT}}}+(?!{_W}))|.)\x20?+"
#: Sets of this size and of one shingle less have keys of subsets too: linked ones differ in one shingle, which may lie in every band.
SPARSE = 5


def plain(line: Column) -> Column:
    return F.trim(F.lower(line))


def hashes(line: Column) -> Column:
    """Hashes of the character shingles of a plain line, repeats included."""
    return F.transform(F.regexp_extract_all(line, F.lit(STARTS), F.lit(1)), lambda s: F.xxhash64(s))


def shingles(line: Column) -> Column:
    """Distinct hashes of the character shingles of a plain line."""
    return F.array_distinct(hashes(line))


def signatures(lines: DataFrame, *keep: str) -> DataFrame:
    """(*keep, low): the SIGNATURE smallest distinct hashes of plain, sorted, or all of fewer; null where id is.

    Most lines have few repeats, so a few more of the sorted hashes than asked hold enough distinct ones; only where they do not are all of them compared.
    """
    head = SIGNATURE + 4
    sorted_ = lines.select(*keep, F.when(F.col("id").isNotNull(), F.sort_array(hashes(F.col("plain")))).alias("all"))
    some = sorted_.select(*keep, "all", F.array_distinct(F.slice("all", 1, head)).alias("head"))
    enough = (F.size("head") >= SIGNATURE) | (F.size("all") <= head)
    return some.select(*keep, F.slice(F.when(enough, F.col("head")).otherwise(F.array_distinct("all")), 1, SIGNATURE).alias("low"))


def bands(low: Column) -> list[Column]:
    """Keys of each BAND neighbours among the sorted smallest hashes, null where there are none; fewer hashes make one key. Columns that a small set
    leaves free hold its keys of subsets."""
    several = [F.when(F.size(low) >= i + BAND, F.xxhash64(*[F.get(low, F.lit(i + j)) for j in range(BAND)])) for i in range(SIGNATURE - BAND + 1)]
    several[0] = F.coalesce(several[0], F.xxhash64(low))
    subset = lambda size, without: F.xxhash64(F.lit("subset"), *[F.get(low, F.lit(i)) for i in range(size) if i != without])
    free = SPARSE - BAND + 1
    for j in range(SPARSE):
        own = F.when(F.size(low) == SPARSE, subset(SPARSE, j))
        several[free + j] = F.coalesce(several[free + j], own.when(F.size(low) == SPARSE - 1, subset(SPARSE - 1, None)) if j == 0 else own)
    return several


def lines_of(docs: DataFrame, min_words: int) -> DataFrame:
    """(uid, doc_id, line_no, id, place, plain): every line of every document; id is null for lines that stay anyway: blank ones and spaced ones with fewer than min_words words.

    place is a hash of doc_id and text, by which the row of a line is found again.
    """
    whole = docs.select("uid", "doc_id", "text", _place().alias("place"))  # before lines become rows, so that a text is hashed once, not for each line
    rows = whole.select("uid", "doc_id", "place", F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n")).alias("line_no", "line"))
    rows = rows.select("uid", "doc_id", "place", "line_no", plain(F.col("line")).alias("plain"))
    p = F.col("plain")
    taken = F.substring(p, 1, 1).between("!", "~") | p.rlike(r"[^\s\p{Z}]")
    if min_words:
        n = F.size(F.split(p, " "))
        taken = taken & ((n >= min_words) | (F.char_length(p) > 16 * n))
    return rows.select("uid", "doc_id", "line_no", F.when(taken, F.xxhash64(p)).alias("id"), "place", "plain")


def _place() -> Column:
    return F.xxhash64("doc_id", "text")


def _verifier(rows: DataFrame, seen: DataFrame, distinct: DataFrame, scratch: Scratch):
    """Verifier of pairs of line ids on whole lines. rows: (doc_id, text), seen: (id, place, line_no), distinct: (id, place). Texts are read once, for all that share a band."""

    def verifier(nodes: DataFrame):
        # one copy of each line that is wanted, by the document that holds it, so texts travel as rows and only wanted lines are taken apart
        wanted = distinct.join(nodes.select(F.col("node").alias("id")), "id").select("id", "place")
        at = seen.where("id is not null").select("id", "place", "line_no").join(wanted, ["id", "place"]).groupBy("id", "place").agg(F.min("line_no").alias("line_no"))
        at = at.groupBy("place").agg(F.collect_list(F.struct("id", "line_no")).alias("wanted"))  # no more than the document has lines
        # rows that repeat a document hold its lines too; the join leaves them in one partition, so one of them stays without another shuffle.
        # The short side is hashed, so only texts that hold a wanted line are sorted
        held = rows.select(_place().alias("place"), "text").join(at.hint("shuffle_hash"), "place").groupBy("place").agg(F.first("text").alias("text"), F.first("wanted").alias("wanted"))
        taken = let(F.split("text", "\n"), lambda lines: F.transform("wanted", lambda w: F.struct(w["id"].alias("id"), plain(F.get(lines, w["line_no"])).alias("plain"))))
        found = held.select(F.explode(taken).alias("w")).select("w.id", "w.plain").where(F.xxhash64("plain") == F.col("id"))
        sets = scratch.write(found.select("id", shingles(F.col("plain")).alias("s")), hashes=True)

        def links(pairs: DataFrame) -> DataFrame:
            both = pairs.join(sets.select(F.col("id").alias("a"), F.col("s").alias("x")), "a").join(sets.select(F.col("id").alias("b"), F.col("s").alias("y")), "b")
            na, nb, common = F.size("x").cast("long"), F.size("y").cast("long"), F.size(F.array_intersect("x", "y")).cast("long")
            delta = F.when(F.col("differ"), F.concat(F.array_except("x", "y"), F.array_except("y", "x")))
            return scratch.write(both.select("a", "b", (5 * common >= 4 * (na + nb - common)).alias("linked"), na.alias("na"), nb.alias("nb"), (na + nb - 2 * common).alias("n"), delta.alias("delta")))

        return links

    return verifier


def decisions(docs: DataFrame, min_words: int = ALL) -> DataFrame:
    """One row per line: uid, doc_id, line_no, keep_doc_id, keep_line_no (of the line that stays for it), kept."""
    rows = docs.select(F.monotonically_increasing_id().alias("uid"), "doc_id", "text")
    return _decisions(rows, min_words, Scratch(docs.sparkSession))


def _decisions(rows: DataFrame, min_words: int, scratch: Scratch) -> DataFrame:
    """decisions() for rows (uid, doc_id, text); of the scratch tables only those that the result reads are left."""
    lines = lines_of(rows, min_words)
    names = [f"k{i}" for i in range(SIGNATURE - BAND + 1)]
    signed = signatures(lines, "id", "place").select("id", "place", *[k.alias(n) for n, k in zip(names, bands(F.col("low")), strict=True)])
    # values of fixed width, so that equal lines are combined by hash before the shuffle; only distinct lines carry keys
    distinct = signed.groupBy("id").agg(F.min("place").alias("place"), F.count("id").alias("copies"), *[F.max(n).alias(n) for n in names])
    # a filter on id would be moved down to the lines, which would be made plain again for it
    distinct = scratch.write(distinct.where("copies > 0"), hashes=True)
    seen = scratch.write(lines.select("uid", "doc_id", "line_no", "id", "place"), hashes=True)
    keys = distinct.select(F.explode(F.array(*names)).alias("key"), F.col("id").alias("node"), F.lit(0).alias("slack")).where("key is not null")
    found = linked_by_keys(keys, _verifier(rows, seen, distinct, scratch), scratch)

    # only lines with copies or links go on to be grouped
    same = distinct.where("copies > 1").select("id").join(found.select(F.col("node").alias("id")), "id", "left_anti").select("id", F.col("id").alias("c"))
    groups = found.select(F.col("node").alias("id"), F.col("component").alias("c")).unionByName(same)
    named = scratch.write(seen.select("uid", "doc_id", "line_no", "id").join(groups, "id", "left").select("uid", "doc_id", "line_no", "c"))
    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "uid", "line_no")
    # a table of its own, so that the join has an exchange on either side and the rows of a frequent line can be split
    first = scratch.write(named.where("c is not null").groupBy("c").agg(F.min(order).alias("keep")))
    shared = named.where("c is not null").join(first, "c").select("uid", "doc_id", "line_no", F.col("keep.doc_id").alias("keep_doc_id"), F.col("keep.line_no").alias("keep_line_no"), ((F.col("keep.uid") == F.col("uid")) & (F.col("keep.line_no") == F.col("line_no"))).alias("kept"))
    scratch.keep(named, first)
    alone = named.where("c is null").select("uid", "doc_id", "line_no", F.col("doc_id").alias("keep_doc_id"), F.col("line_no").alias("keep_line_no"), F.lit(True).alias("kept"))
    return shared.unionByName(alone)


def dedup_lines(docs: DataFrame, min_words: int = ALL) -> DataFrame:
    """docs without the dropped lines; rows that had lines and are left with none are dropped. Each row loses its own lines only."""
    scratch, inner = Scratch(docs.sparkSession), Scratch(docs.sparkSession)
    rows = scratch.write(docs.select(F.monotonically_increasing_id().alias("uid"), "doc_id", "text", F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"]).alias("rest")))
    said = _decisions(rows.select("uid", "doc_id", "text"), min_words, inner)
    gone = scratch.write(said.where("not kept").groupBy("uid").agg(F.collect_set("line_no").alias("gone")))
    inner.keep()
    left = let(F.split("text", "\n"), lambda lines: F.transform(F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("gone")), lambda i: lines[i]))
    text = F.when(F.col("gone").isNull(), F.col("text")).otherwise(F.array_join(left, "\n"))
    out = rows.join(gone, "uid", "left").select("gone", text.alias("text"), "rest").where(F.col("gone").isNull() | F.col("text").rlike(r"[^\s\p{Z}]"))
    return out.select(*[F.col("text") if c == "text" else F.col(f"rest.`{c}`") for c in docs.columns])
