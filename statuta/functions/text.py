"""Texts as Column expressions. Folding keeps one character for one, so offsets stay valid."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .identifiers import PLAIN, POLISH

DASHES = "‐‑‒–—―−"
# What pages read with the wrong 8-bit encoding show for the Polish letters, in the order of MOJIBAKE_TO.
MOJIBAKE_FROM, MOJIBAKE_TO = "πÊÍ≥ÒÛúüø", "ąćęłńóśźż"
REPLACEMENT = "�"


def folded(s: Column) -> Column:
    """F-02: lower case without Polish diacritics."""
    return F.translate(F.lower(s), POLISH, PLAIN)


def dashes_folded(s: Column) -> Column:
    """F-03: lower case with every dash as a hyphen."""
    return F.translate(F.lower(s), DASHES, "-" * len(DASHES))


def has_phrase(s: Column, phrase: str) -> Column:
    """F-02: case- and diacritic-insensitive substring; no phrase matches everything."""
    return folded(s).contains(folded(F.lit(phrase))) if phrase else F.lit(True)


def regex_literal(phrase: str) -> str:
    """F-04: a pattern that matches the phrase as it stands."""
    return "".join("\\" + c if c in "\\.^$*+?()[]{}|" else c for c in phrase)


def regex_or_literal(phrase: str) -> tuple[str, str]:
    """F-04: (pattern, 'as written' | 'superset' | 'literal'). Word-edge escapes of other dialects become \\b, possessive marks are dropped
    (a superset), and what does not compile is matched literally."""
    import re

    pattern = re.sub(r"\\[mMyY<>]", r"\\b", phrase)
    wider = re.sub(r"(?<!\\)([*+?}])\+", r"\1", pattern)
    try:
        re.compile(wider)
    except re.error:
        return regex_literal(phrase), "literal"
    return wider, "as written" if wider == phrase else "superset"


def replacement_chars(s: Column) -> Column:
    """A-10: how many characters could not be decoded."""
    return F.char_length(s) - F.char_length(F.replace(s, F.lit(REPLACEMENT), F.lit("")))


def word_chars(s: Column) -> Column:
    """A-08: letters and digits; a page with under 20 has no text."""
    return F.char_length(F.regexp_replace(F.coalesce(s, F.lit("")), r"[^\p{L}\p{N}_]", ""))


def quality_notes(s: Column) -> Column:
    """X-05: what speaks against a text, as an array."""
    return F.array_compact(F.array(
        F.when(F.coalesce(F.trim(s), F.lit("")) == "", "empty"), F.when(replacement_chars(s) > 0, "undecodable characters"),
        F.when(word_chars(s) < 20, "almost no text"), F.when(~s.contains("."), "no sentence")))


def html_text(html: Column) -> Column:
    """X-01, simple form: block tags are line breaks, scripts and other tags go, common entities are resolved."""
    s = F.regexp_replace(html, r"(?is)<(script|style|button)\b.*?</(script|style|button)>", "")
    s = F.regexp_replace(s, r"(?i)<(br|/p|/div|/li|/tr|/h[1-6])[^>]*>", "\n")
    s = F.regexp_replace(s, r"<[^>]*>", "")
    for name, char in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        s = F.replace(s, F.lit(name), F.lit(char))
    s = F.regexp_replace(F.translate(s, " \t\r", "   "), r" +", " ")
    s = F.regexp_replace(F.regexp_replace(s, r" ?\n ?", "\n"), r"\n{3,}", "\n\n")
    return F.regexp_replace(s, r"^[ \n]+|[ \n]+$", "")


def ocr_repaired(s: Column) -> Column:
    """X-22: '$' and '8' read for a section sign, where the context says so."""
    s = F.regexp_replace(s, r"\$(?=\s*\d)", "§")
    s = F.regexp_replace(s, r"(?<![\p{L}\p{N}§])((?:w|z|do|zastrzeżeniem) )8 ([1-9]\d?)(?= (?:ust\.|pkt))", "$1§ $2")
    return F.regexp_replace(s, r"(?<![\p{L}\p{N}§])(art\. ?\d{1,6}[a-z]* )8 (\d{1,2})(?= \p{L})", "$1§ $2")


def mojibake_repaired(s: Column) -> Column:
    """X-23: letters of a page read with the wrong encoding, where it has such characters and no Polish letter."""
    return F.when(s.rlike(f"[{MOJIBAKE_FROM}]") & ~s.rlike(f"[{POLISH}]"), F.translate(s, MOJIBAKE_FROM, MOJIBAKE_TO)).otherwise(s)


def dehyphenated(s: Column) -> Column:
    """X-13: words that were divided at a line end."""
    return F.regexp_replace(F.regexp_replace(s, r"[-­]\n(?=\p{Ll})", ""), r"-\n-(?=\p{L})", "-")


def damage_reasons(s: Column) -> Column:
    """X-11: why a cited provision looks damaged."""
    return F.array_compact(F.array(
        F.when(s.rlike(r"(?i)art\.\s*+(?:$|\D)"), "article without number"), F.when(s.rlike(r"\d{4}\s*r?\.?\s*Nr\s*0\b"), "journal number 0"),
        F.when(s.rlike(r"\bpoz\.\s*+(?:$|\D)"), "position missing"), F.when(replacement_chars(s) > 0, "undecodable characters")))


def correction_scope(s: Column) -> Column:
    """X-10: units that the headings of a correction name, by number and then letter."""
    units = F.array_distinct(F.regexp_extract_all(s, F.lit(r"(?i)(?:article|artykuł|art\.)\s+(\d+[a-z]?)"), F.lit(1)))
    keyed = F.transform(units, lambda u: F.struct(F.regexp_extract(u, r"^(\d+)", 1).cast("int").alias("n"), u.alias("u")))
    return F.transform(F.array_sort(keyed), lambda x: x["u"])


def text_verdict(s: Column, page_break: str = "\f") -> Column:
    """X-05: struct(notes, blocked): quality_notes(), and whether only the first of several pages has text and whether no unit is marked; blocked says that
    nothing may be concluded: no text, or more than one character in a hundred lost."""
    pages = F.split(F.coalesce(s, F.lit("")), page_break)
    rest = F.slice(pages, 2, F.greatest(F.size(pages) - 1, F.lit(0)))
    first_only = (F.size(pages) > 1) & (word_chars(pages[0]) >= 20) & F.forall(rest, lambda p: word_chars(p) < 20)
    more = F.array_compact(F.array(F.when(first_only, "only the first page has text"), F.when(~F.coalesce(s, F.lit("")).rlike(r"(?m)^\s*(?:Art\.|§)"), "no unit")))
    blocked = (word_chars(s) == 0) | (100 * F.coalesce(replacement_chars(s), F.lit(0)) > F.coalesce(F.char_length(s), F.lit(0)))
    return F.struct(F.concat(quality_notes(s), more).alias("notes"), blocked.alias("blocked"))
