"""Dates of legal documents as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Month names in the genitive, January first.
MONTHS = ("stycznia", "lutego", "marca", "kwietnia", "maja", "czerwca", "lipca", "sierpnia", "września", "października", "listopada", "grudnia")
# Dates that stand for no date.
NO_END, UNSPECIFIED, MISSING, OPEN = "9999-12-31", "1001-01-01", "0001-01-01", "2099-12-31"


def month_number(name: Column) -> Column:
    return F.nullif(F.array_position(F.array(*map(F.lit, MONTHS)), F.lower(name)), F.lit(0)).cast("int")


def polish_date(s: Column) -> Column:
    """D-01: date from ISO or '9 listopada 2021'; the first date in a longer text."""
    pattern = r"(?iu)(\d{1,2})\s+(%s)\s+(\d{4})" % "|".join(MONTHS)
    parts = [F.regexp_extract(s, pattern, i) for i in (1, 2, 3)]
    named = F.when(s.rlike(pattern), F.try_to_date(F.concat_ws("-", parts[2], F.lpad(month_number(parts[1]).cast("string"), 2, "0"), F.lpad(parts[0], 2, "0"))))
    return F.coalesce(F.when(F.trim(s).rlike(r"^\d{4}-\d{2}-\d{2}$"), F.try_to_date(F.trim(s))), named)


def in_words(d: Column) -> Column:
    """D-01: '9 listopada 2021 r.'"""
    return F.concat(F.dayofmonth(d).cast("string"), F.lit(" "), F.element_at(F.array(*map(F.lit, MONTHS)), F.month(d)), F.lit(" "), F.year(d).cast("string"), F.lit(" r."))


def local_date(s: Column, zone: str = "Europe/Warsaw") -> Column:
    """D-02: civil date of a UTC instant; of other texts the ISO date at the front."""
    instant = F.when(s.rlike(r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}(?::\d{2}(?:\.\d+)?)?(?:Z|[+-]00:?00)$"), F.regexp_replace(F.replace(F.regexp_extract(s, r"^([0-9T:-]+?)(?:\.\d+)?(?:Z|[+-]00:?00)$", 1), F.lit("T"), F.lit(" ")), r"^(.{16})$", "$1:00"))
    return F.coalesce(F.to_date(F.from_utc_timestamp(F.try_to_timestamp(instant), zone)), F.try_to_date(F.substring(F.trim(s), 1, 10)))


def known_date(s: Column) -> Column:
    """D-03: ISO or dd.mm.yyyy; values that stand for no date are null."""
    iso = F.when(s.rlike(r"^\d{4}-\d{2}-\d{2}"), F.substring(s, 1, 10))
    iso = F.coalesce(iso, F.when(s.rlike(r"^\d{2}\.\d{2}\.\d{4}"), F.concat_ws("-", F.substring(s, 7, 4), F.substring(s, 4, 2), F.substring(s, 1, 2))))
    return F.when(~iso.isin(NO_END, UNSPECIFIED, MISSING, OPEN), F.try_to_date(iso))


def widened(s: Column, end: bool) -> Column:
    """F-05: the first or last day of a full or partial date."""
    year, month = F.regexp_extract(s, r"^(\d{4})", 1).try_cast("int"), F.regexp_extract(s, r"^\d{4}-(\d{2})$", 1).try_cast("int")
    whole = F.when(s.rlike(r"^\d{4}-\d{2}-\d{2}$"), F.try_to_date(s))
    by_month = F.when(s.rlike(r"^\d{4}-(?:0[1-9]|1[0-2])$"), F.make_date(year, month, F.lit(1)))
    by_year = F.when(s.rlike(r"^\d{4}$"), F.make_date(year, F.lit(12 if end else 1), F.lit(31 if end else 1)))
    return F.coalesce(whole, F.last_day(by_month) if end else by_month, by_year)


def entry_date(note: Column) -> Column:
    """D-04: the last 'enters into force on' date of a note; it is the one about the provision itself."""
    when = r"(?iu)wej(?:dzie|dą|ście)\s+w\s+życie\s+z\s+dn(?:iem|\.|ia)\s+(\d{1,2}\s+\p{L}+\s+\d{4}|\d{1,2}\.\d{2}\.\d{4})"
    found = F.regexp_extract_all(F.coalesce(note, F.lit("")), F.lit(when), F.lit(1))
    dates = F.filter(F.transform(found, lambda x: F.coalesce(polish_date(x), known_date(F.lpad(x, 10, "0")))), lambda d: d.isNotNull())
    return F.when(F.size(dates) > 0, F.element_at(dates, -1))


def undated_entry(note: Column) -> Column:
    """D-04: class of a note on a future entry without a date: 'announcement' or 'unknown'; '' for others."""
    future = note.rlike(r"(?iu)wej(?:dzie|dą)\s+w\s+życie") & entry_date(note).isNull()
    return F.when(F.coalesce(future, F.lit(False)), F.when(F.lower(note).contains("komunikac"), "announcement").otherwise("unknown")).otherwise("")


def ordered_dates(made: Column, published: Column) -> Column:
    """D-05: struct(made, published), exchanged where publication would be before the act."""
    return F.struct(F.least(made, published).alias("made"), F.greatest(made, published).alias("published"))


def end_of_validity(dates: Column, partial: Column) -> Column:
    """D-06: struct(end, partial) from all end dates of an act (ISO strings) and those annotated as partial."""
    every = F.array_sort(F.array_distinct(dates))
    rest = F.array_except(every, partial)
    forever = F.array_contains(every, NO_END)
    end = F.when(forever, NO_END).otherwise(F.array_max(rest))
    return F.struct(end.alias("end"), F.filter(every, lambda d: ~d.eqNullSafe(end)).alias("partial"))


def future(d: Column, today: Column) -> Column:
    """F-11: whether a date is an error because it lies in the future."""
    return F.coalesce(d > today, F.lit(False))
