"""Identifiers and citations of legal documents as Column expressions; what is not recognised is null."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

POLISH, PLAIN = "ąćęłńóśźżĄĆĘŁŃÓŚŹŻ", "acelnoszzACELNOSZZ"
SUPERSCRIPTS, DIGITS = "⁰¹²³⁴⁵⁶⁷⁸⁹", "0123456789"
# Check weights of the two registry numbers.
NIP_WEIGHTS = (6, 5, 7, 2, 3, 4, 5, 6, 7)
REGON9_WEIGHTS = (8, 9, 2, 3, 4, 5, 6, 7)
REGON14_WEIGHTS = (2, 4, 8, 5, 0, 9, 7, 3, 6, 1, 2, 4, 8)
# Case registers of the administrative courts.
ADMINISTRATIVE = ("sa", "sab", "osk", "oz", "ops", "gsk", "gz", "gps", "fsk", "fz", "fps", "nsa")
# Case registers of the Constitutional Tribunal, the Supreme Court and the common courts.
TRIBUNAL = ("K", "SK", "P", "U", "Kp", "Kpt", "Ts", "Tw", "S", "Pp", "M", "W")
SUPREME = ("CSK", "CSKP", "CNP", "CNPP", "CZ", "CZP", "CO", "KK", "KO", "KS", "KZ", "KZP", "KSKP", "PK", "PO", "PZ", "PZP", "PSKP", "UK", "UO", "UZ", "UZP", "USK", "USKP", "NSNc", "NSNk", "DSI")
COMMON = ("C", "Ca", "ACa", "Cz", "ACz", "Co", "Nc", "Ns", "GC", "Ga", "AGa", "GCo", "RC", "RCa", "RNs", "Nsm", "K", "Ka", "AKa", "Ko", "Kop", "Kp", "Kz", "AKz", "W", "P", "Pa", "APa", "Np", "U", "Ua", "AUa")
# Letters of the instruments in a CELEX number.
INSTRUMENTS = {"reg": "R", "dir": "L", "dec": "D"}


def extract(s: Column, pattern: str, group: int = 1) -> Column:
    """The group of the first match, null without one."""
    return F.when(s.rlike(pattern), F.regexp_extract(s, pattern, group))


def act_path(s: Column) -> Column:
    """I-01: canonical path of an act from any of its spellings: a journal, a year and a position, or one address of 11 digits."""
    tokens = F.regexp_extract_all(F.upper(s), F.lit(r"(\p{Lu}+|\d+)"))
    numbers = F.filter(tokens, lambda t: t.rlike(r"^\d"))
    letters = F.array_join(F.filter(tokens, lambda t: ~t.rlike(r"^\d")), "")
    journal = F.when(letters.rlike("^W?MP"), "MP").otherwise("DU")
    address = (F.size(numbers) == 1) & F.get(numbers, F.lit(0)).rlike(r"^\d{11}$") & letters.isin("DU", "MP", "WDU", "WMP")
    year_at = F.array_position(F.transform(numbers, lambda n: n.rlike(r"^(19|20)\d\d$")), True)
    position = F.get(numbers, F.when(year_at == F.size(numbers), F.size(numbers) - 2).otherwise(F.size(numbers) - 1).cast("int"))
    path = F.concat_ws("/", F.lit("/acts"), journal, F.get(numbers, (year_at - 1).cast("int")), position.try_cast("long").cast("string"))
    return F.when(address, F.concat(F.lit("/acts/W"), journal, numbers[0])).when((F.size(numbers) > 1) & (year_at > 0), path)


def celex(s: Column) -> Column:
    """I-02: CELEX number from itself or from a European Legislation Identifier, whose path names instrument, year and number in turn."""
    steps = F.split(F.lower(F.trim(s)), "/")
    kind = lambda x: F.coalesce(*[F.when(x.startswith(k), v) for k, v in INSTRUMENTS.items()])
    at = F.array_position(F.transform(steps, lambda x: kind(x).isNotNull()), True).cast("int")
    year, number = F.get(steps, at), F.get(steps, at + 1)
    named = F.concat(F.lit("3"), year, kind(F.get(steps, at - 1)), F.lpad(number.try_cast("long").cast("string"), 4, "0"))
    code = F.regexp_replace(F.upper(F.regexp_replace(s, r"\s", "")), "^CELEX:?", "")
    sector_year, tail = F.regexp_extract(code, r"^(\d{5})[A-Z]{1,2}", 1), F.regexp_extract(code, r"^\d{5}[A-Z]{1,2}(.+)$", 1)
    whole = (sector_year != "") & ((tail == "/TXT") | tail.rlike(r"^\d+(?:R?\(\d\d\))*(?:-\d{8})?$"))
    return F.when((at > 0) & year.rlike(r"^\d{4}$") & number.rlike(r"^\d+$"), named).when(whole, code)


def base_of_consolidated(number: Column) -> Column:
    """I-02: base act of a consolidated version, others unchanged."""
    return F.when(number.rlike(r"^0\d{4}[A-Z]"), F.concat(F.lit("3"), F.regexp_extract(number, r"^0(.*?)(?:-\d{8})?$", 1))).otherwise(number)


def urn(s: Column) -> Column:
    """I-03: URN of a decision or a court file from its signature; a URN in lower case.

    A court file is division, register with an optional town, and number with year; a decision is marks and numbers that end with a year.
    """
    s = F.trim(s)
    words = F.split(s, r"\s+")
    register, file = F.split(F.get(words, F.lit(1)), "/"), F.split(F.get(words, F.lit(2)), "/")
    year = F.get(file, F.lit(1))
    full_year = F.when(F.length(year) == 4, year).otherwise(F.concat(F.when(year < "50", "20").otherwise("19"), year))
    is_file = (F.size(words) == 3) & F.upper(words[0]).rlike("^[IVXL]+$") & F.get(file, F.lit(0)).rlike(r"^\d+$") & year.rlike(r"^(\d\d|\d{4})$") & (F.size(register) <= 2) & register[0].rlike(r"^\p{L}+$")
    branch = F.when(F.lower(register[0]).isin(*ADMINISTRATIVE), "sa").otherwise("sp")
    name = F.concat_ws("_", F.lower(words[0]), F.lower(F.array_join(register, "-")), F.get(file, F.lit(0)))
    marks = F.split(s, r"[.\s/]+")
    is_decision = (F.size(marks) > 1) & F.element_at(marks, -1).rlike(r"^(19|20)\d\d$")
    mark = F.translate(F.lower(F.array_join(F.slice(marks, 1, F.greatest(F.size(marks) - 1, F.lit(0))), "_")), POLISH, PLAIN)
    return (
        F.when(F.lower(s).startswith("urn:"), F.lower(s))
        .when(is_file, F.concat_ws(":", F.lit("urn:ndoc:court:pl"), branch, full_year, name))
        .when(is_decision, F.concat_ws(":", F.lit("urn:ndoc:gov:pl:uodo"), F.element_at(marks, -1), mark))
    )


def signature_of_urn(s: Column) -> Column:
    """I-03: signature of a court file from its URN; others unchanged.

    The parts of a URN are split, not matched: country, court, year and name; a name is division, register with an optional town, and the number.
    Registers of the common courts have their own capitals, all others only capitals.
    """
    parts = F.split(F.lower(F.trim(s)), ":")
    court, year = F.get(parts, F.lit(3)), F.get(parts, F.lit(5))
    name = F.split(F.get(parts, F.lit(6)), "_")
    register = F.split(F.get(name, F.lit(1)), "-")
    number = F.get(F.filter(F.slice(name, 2, 99), lambda x: x.rlike(r"^\d+$")), F.lit(0))
    spelled = F.create_map(*[F.lit(x) for r in COMMON for x in (r.lower(), r)])
    town = F.get(register, F.lit(1))
    file = F.concat(number, F.lit("/"), F.right(year, F.lit(2)))
    national = F.concat_ws(" ", F.upper(name[0]), F.concat(F.coalesce(F.try_element_at(spelled, register[0]), F.upper(register[0])), F.coalesce(F.concat(F.lit("/"), F.initcap(town)), F.lit(""))), file)
    is_file = (F.size(parts) == 7) & F.array_join(F.slice(parts, 1, 3), ":").eqNullSafe("urn:ndoc:court") & year.rlike(r"^\d{4}$") & number.isNotNull()
    return (
        F.when(is_file & (court == "pl") & F.get(parts, F.lit(4)).isin("sa", "sp") & (F.size(name) > 2), national)
        .when(is_file & (court == "eu") & (name[0] == "c"), F.concat(F.lit("C-"), file)).otherwise(F.trim(s))
    )


def document_id(s: Column) -> Column:
    """I-04: document id from itself or from a URL's id parameter."""
    return F.coalesce(extract(s, r"^\s*([0-9]{4,}_[0-9A-Za-z_]+|[0-9]+)\s*$"), extract(s, r"[?&]id=([^&#]+)"), extract(s, r"/(?:doc|details|content)/([^/?#]+)"))


def case_number(s: Column) -> Column:
    """I-05: upper case, single spaces."""
    return F.upper(F.trim(F.regexp_replace(F.coalesce(s, F.lit("")), r"\s+", " ")))


def case_year(s: Column) -> Column:
    """I-05: year of a case number; two digits from 50 on are of the last century."""
    n = extract(s, r"/(\d{2,4})\s*$").cast("int")
    return F.when(n >= 1000, n).when(n >= 50, 1900 + n).otherwise(2000 + n)


def court_of(s: Column) -> Column:
    """I-06: kind of court from a case number, by its register; null for an unknown one. Only the tribunal and the chamber have no division."""
    words = F.split(F.trim(s), r"\s+")
    register, divided = F.get(words, F.size(words) - 2), (F.size(words) == 3) & words[0].rlike("^[IVXL]+$")
    numbered = F.element_at(words, -1).rlike(r"^\d+/\d{2,4}$")
    plain = (F.size(words) == 2) & numbered
    return (
        F.when(plain & (F.upper(register) == "KIO"), "NATIONAL_APPEAL_CHAMBER").when(plain & register.isin(*TRIBUNAL), "CONSTITUTIONAL_TRIBUNAL")
        .when(divided & numbered & register.isin(*SUPREME), "SUPREME").when(divided & numbered & register.isin(*COMMON), "COMMON")
    )


def organ_mark(s: Column) -> Column:
    """I-07: first file mark of an authority in a text, as in DKN.5131.9.2025."""
    return extract(s, r"\b([A-ZĄĆĘŁŃÓŚŹŻ]{2,}(?:[-.][A-Z0-9]+)*\.\d+(?:\.\d+)*\.(?:19|20)\d{2})\b")


def judgment_signatures(s: Column) -> Column:
    """I-08: distinct signatures of administrative judgments in a text, in order: division, register, town or none, number and year."""
    registers = "|".join(sorted((r.upper() for r in ADMINISTRATIVE), key=lambda r: (-len(r), r)))
    signature = rf"(?<![\p{{L}}\d])[IVXL]+\x20(?:{registers})(?:/\p{{Lu}}\p{{Ll}}+)?\x20\d+/\d\d(?!\d)"
    return F.array_distinct(F.regexp_extract_all(F.coalesce(s, F.lit("")), F.lit(signature), F.lit(0)))


def cited_positions(s: Column) -> Column:
    """I-09: 'year/position' of each journal position cited in a text; a missing year is the last one before it."""
    found = F.regexp_extract_all(F.coalesce(s, F.lit("")), F.lit(r"(?:Dz\.\s*U\.(?:\s*z\s*\d{4}\s*r\.)?(?:\s*\d{4})?|poz\.\s*\d+|\bi\s+\d+|,\s*\d+)"), F.lit(0))
    step = lambda acc, x: F.struct(
        F.coalesce(F.when(x.startswith("Dz"), extract(x, r"(\d{4})")), acc["year"]).alias("year"),
        F.when(x.startswith("Dz"), acc["out"]).otherwise(F.array_append(acc["out"], F.concat_ws("/", F.coalesce(acc["year"], F.lit("?")), F.regexp_extract(x, r"(\d+)", 1)))).alias("out"))
    start = F.struct(F.lit(None).cast("string").alias("year"), F.array().cast("array<string>").alias("out"))
    return F.array_distinct(F.aggregate(found, start, step, lambda acc: acc["out"]))


def citation(publisher: Column, year: Column, position: Column, consolidated: Column) -> Column:
    """I-10: official citation of an act; consolidated: whether it is a consolidated text."""
    journal = F.when(publisher == "DU", "Dz. U.").when(publisher == "MP", "M. P.").otherwise(publisher)
    return F.concat(F.when(consolidated, "t.j. ").otherwise(""), journal, F.lit(" z "), year.cast("string"), F.lit(" r. poz. "), position.cast("string"))


def _check(digits: Column, weights: tuple, ten_is_zero: bool) -> Column:
    total = sum((F.substring(digits, i + 1, 1).cast("int") * w for i, w in enumerate(weights)), F.lit(0)) % 11
    last = F.substring(digits, len(weights) + 1, 1).cast("int")
    return (F.when(total == 10, 0).otherwise(total) == last) if ten_is_zero else (total == last) & (total != 10)


def nip_ok(s: Column) -> Column:
    """I-11: whether a tax number has ten digits and the right check digit."""
    d = F.regexp_replace(s, r"[\s-]", "")
    return F.when(d.rlike(r"^\d{10}$"), _check(d, NIP_WEIGHTS, False)).otherwise(False)


def regon_ok(s: Column) -> Column:
    """I-11: whether a statistical number has 9 or 14 digits and the right check digit."""
    d = F.regexp_replace(s, r"[\s-]", "")
    return F.when(d.rlike(r"^\d{9}$"), _check(d, REGON9_WEIGHTS, True)).when(d.rlike(r"^\d{14}$"), _check(d, REGON14_WEIGHTS, True)).otherwise(False)


def unit_key(number: Column) -> Column:
    """I-12: '4 1' and '477 6 a' as '4^1' and '477^6a'."""
    parts = F.filter(F.split(F.lower(F.trim(number)), r"\s+"), lambda p: p != "")
    return F.when(F.size(parts) > 1, F.concat(parts[0], F.lit("^"), F.array_join(F.slice(parts, 2, F.size(parts)), ""))).otherwise(F.coalesce(F.get(parts, F.lit(0)), F.lit("")))


def article_key(phrase: Column) -> Column:
    """I-12: key of the article a phrase names: 'art. 4(1)', 'art. 4¹' and 'art. 4^1' are '4^1'; '' if it names none."""
    pattern = r"(?i)^art\.?\s*(\d+[a-z]*)(?:\((\d+)|\^(\d+)|([⁰¹²³⁴⁵⁶⁷⁸⁹]+))?([a-z]*)\)?"
    s = F.trim(F.coalesce(phrase, F.lit("")))
    index = F.concat(F.regexp_extract(s, pattern, 2), F.regexp_extract(s, pattern, 3), F.translate(F.regexp_extract(s, pattern, 4), SUPERSCRIPTS, DIGITS))
    return F.when(s.rlike(pattern), F.lower(F.concat(F.regexp_extract(s, pattern, 1), F.when(index != "", F.concat(F.lit("^"), index)).otherwise(""), F.regexp_extract(s, pattern, 5)))).otherwise("")


UNIT = r"\d+[a-z]*(?:\x20\d+[a-z]*)*"
UNIT_LIST = rf"{UNIT}(?:(?:\s*,\s*|\s+i\s+|\s+oraz\s+|\s*[–—-]\s*)(?:art\.\s*)?{UNIT})*"


def plain_numbers(text: Column) -> Column:
    """Indices written above the line or in brackets, as further numbers after a space: art. 4¹, art. 4^1 and art. 4(1) are 'art. 4 1'."""
    raised = F.regexp_replace(text, rf"(?<=\d|[a-z])([{SUPERSCRIPTS}]+)", " $1")
    return F.regexp_replace(F.translate(raised, SUPERSCRIPTS, DIGITS), r"(?i)(?<=art\. ?)(\d+[a-z]*)(?:\((\d+[a-z]*)\)|\^(\d+[a-z]*))", "$1 $2$3")


def unit_list(s: Column) -> Column:
    """I-13: struct(keys, ranges) of '5, 6 i 8' or '459–478'; ranges that cannot be spelled out are 'from..to'.

    A unit is a number with letters, and further such numbers after single spaces; a dash makes two of them a range.
    """
    unit = r"\d+[a-z]*(?:\x20\d+[a-z]*)*"
    grammar = F.lit(rf"({unit})(?:\s*[–—-]\s*({unit}))?")
    low = F.lower(s)
    pairs = F.zip_with(F.regexp_extract_all(low, grammar, F.lit(1)), F.regexp_extract_all(low, grammar, F.lit(2)), lambda a, b: F.struct(unit_key(a).alias("a"), unit_key(b).alias("b")))
    span = lambda p: p["b"].try_cast("int") - p["a"].try_cast("int")
    counted = lambda p: F.coalesce(span(p).between(1, 400), F.lit(False))
    spelled = lambda p: F.transform(F.sequence(p["a"].try_cast("int"), p["b"].try_cast("int")), lambda n: n.cast("string"))
    keys = F.transform(pairs, lambda p: F.when(p["b"] == "", F.array(p["a"])).when(counted(p), spelled(p)).otherwise(F.array(p["a"], p["b"])))
    ranges = F.transform(F.filter(pairs, lambda p: (p["b"] != "") & ~counted(p)), lambda p: F.concat_ws("..", p["a"], p["b"]))
    return F.struct(F.array_sort(F.array_distinct(F.flatten(keys))).alias("keys"), ranges.alias("ranges"))


# The same grammar for folds over texts. Java's patterns know white space, digits and case of ASCII only, but word edges of all letters.
SPACE = r"[ \t\n\x0b\f\r]"
TEXT_UNIT = r"[0-9]+[A-Za-z]*(?:\x20[0-9]+[A-Za-z]*)*"
TEXT_UNIT_LIST = rf"{TEXT_UNIT}(?:(?:{SPACE}*,{SPACE}*|{SPACE}+[iI]{SPACE}+|{SPACE}+[oO][rR][aA][zZ]{SPACE}+|{SPACE}*[–—-]{SPACE}*)(?:[aA][rR][tT]\.{SPACE}*)?{TEXT_UNIT})*"
_ART = re.compile(rf"[aA][rR][tT]\.{SPACE}*")
_PAIR = re.compile(rf"({TEXT_UNIT})(?:{SPACE}*[–—-]{SPACE}*({TEXT_UNIT}))?")
_RAISED = re.compile(rf"(?<=[0-9a-z])(?=[{SUPERSCRIPTS}])")
_TO_DIGITS = str.maketrans(SUPERSCRIPTS, DIGITS)
_INDEX = re.compile(r"(?:(?<=[aA][rR][tT]\.)|(?<=[aA][rR][tT]\. ))([0-9]+[A-Za-z]*)(?:\(([0-9]+[A-Za-z]*)\)|\^([0-9]+[A-Za-z]*))")


def plain_numbers_of(text: str) -> str:
    """plain_numbers() of one text, for folds."""
    return _INDEX.sub(lambda m: f"{m[1]} {m[2] or m[3]}", _RAISED.sub(" ", text).translate(_TO_DIGITS))


def _key_of(number: str) -> str:
    first, *rest = number.split()
    return f"{first}^{''.join(rest)}" if rest else first


def units_of(said: str) -> tuple[set[str], list[str]]:
    """unit_list() of one list, for folds: keys and ranges. The word for articles may stand in it."""
    keys, ranges = set(), []
    for a, b in _PAIR.findall(_ART.sub("", said).lower()):
        a, b = _key_of(a), _key_of(b) if b else ""
        low, high = (int(x) if x.isdigit() and int(x) < 1 << 31 else None for x in (a, b))
        if low is not None and high is not None and 1 <= high - low <= 400:
            keys.update(map(str, range(low, high + 1)))
        else:
            keys.update((a, b) if b else (a,))
            if b:
                ranges.append(f"{a}..{b}")
    return keys, ranges


def in_range(key: Column, low: Column, high: Column) -> Column:
    """J-12: whether a unit may lie in a range that was not spelled out, by the numbers at the front."""
    number = lambda c: F.regexp_extract(c, r"^(\d+)", 1).try_cast("int")
    return F.coalesce(number(key).between(number(low), number(high)), F.lit(False))


def same_act(a: Column, b: Column) -> Column:
    """I-14: whether two titles name one act: equal first four letters of their first four words of over three letters."""
    stem = lambda t: F.slice(F.transform(F.filter(F.split(F.lower(t), r"[^\p{L}\p{N}]+"), lambda w: F.length(w) > 3), lambda w: F.left(w, F.lit(4))), 1, 4)
    return (stem(a) == stem(b)) & (F.size(stem(a)) > 0)


def follow_up(number: Column, court: Column) -> Column:
    """I-15: ready-made query for the same case elsewhere."""
    return F.concat(F.lit('signature "'), F.replace(number, F.lit('"'), F.lit('\\"')), F.lit('"'), F.when(court.isNotNull(), F.concat(F.lit(' --court "'), court, F.lit('"'))).otherwise(""))


def voided_units(title: Column) -> Column:
    """I-16: main units that a ruling's title declares void, in order; empty if it names none.

    They stand between the word for invalidity and the act, or else behind the words "in the part concerning", up to a comma or a date; what an
    act is about is not its part.
    """
    t = F.regexp_replace(F.coalesce(title, F.lit("")), r"\s+", " ")
    behind = lambda word: F.coalesce(F.get(F.split(t, f"(?iu){word}", 2), F.lit(1)), F.lit(""))
    until = lambda x, stop: F.split(x, f"(?iu){stop}", 2)[0]
    named = lambda x: F.zip_with(*[F.regexp_extract_all(x, F.lit(r"(?i)(§|art\.)\s*(\d+[a-z]?)"), F.lit(i)) for i in (1, 2)], lambda a, b: F.concat_ws(" ", a, b))
    first = named(until(behind("nieważno"), "uchwał|zarządze|rozporządze"))
    second = named(until(behind(r"w\s+częś\w+\s+(?:dotycząc|obejmując|w\s+zakresie)"), r"[,;]|\x20z dnia"))
    return F.array_distinct(F.when(F.size(first) > 0, first).otherwise(second))
