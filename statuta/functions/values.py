"""Numbers, plural forms, lists and maps as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def amount(s: Column) -> Column:
    """D-07: '1 000 000,50' or '1000000.50' as a decimal; no currency is implied."""
    return F.replace(F.translate(s, "   ", ""), F.lit(","), F.lit(".")).try_cast("decimal(18,2)")


def amount_text(v: Column) -> Column:
    """D-07: 5015 as '5 015,00'; an em dash for null."""
    return F.coalesce(F.translate(F.format_number(v, 2), ",.", " ,"), F.lit("—"))


def plural(n: Column, one: str, few: str, many: str) -> Column:
    """D-08: Polish plural form with its number."""
    return F.concat(n.cast("string"), F.lit(" "), F.when(n == 1, one).when((n % 10).between(2, 4) & ~(n % 100).between(12, 14), few).otherwise(many))


def in_language(v: Column, first: str = "pl") -> Column:
    """D-09: text of a map language -> text, in the wished language or else any."""
    return F.coalesce(F.element_at(v, first), F.get(F.map_values(v), F.lit(0)))


def as_list(v: Column) -> Column:
    """D-10: list without empty entries; null is an empty list."""
    return F.coalesce(F.filter(v, lambda x: x.isNotNull() & (x != "")), F.array().cast("array<string>"))


def last_by_use(entries: Column) -> Column:
    """D-12: array of (use, date) as a map; of several dates for a use the last one counts."""
    uses = F.array_distinct(F.transform(entries, lambda e: e["use"]))
    return F.map_from_arrays(uses, F.transform(uses, lambda u: F.element_at(F.filter(entries, lambda e: e["use"] == u), -1)["date"]))


def first_and_more(v: Column, k: int) -> Column:
    """L-08: the first k entries, and how many more there are."""
    return F.concat(F.array_join(F.slice(v, 1, k), ", "), F.when(F.size(v) > k, F.concat(F.lit(" (+"), (F.size(v) - k).cast("string"), F.lit(")"))).otherwise(""))


def party_order(parties: Column) -> Column:
    """L-03: the first party stays first, the others in the order of kind, name and numbers (their struct order)."""
    return F.concat(F.slice(parties, 1, 1), F.array_sort(F.slice(parties, 2, F.greatest(F.size(parties), F.lit(1)))))


def lower_keys(json: Column) -> Column:
    """D-11: a flat JSON object with its keys in lower case."""
    return F.to_json(F.transform_keys(F.from_json(json, "map<string,string>"), lambda k, _: F.lower(k)))
