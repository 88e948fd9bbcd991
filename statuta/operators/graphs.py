"""Graph patterns over triples (s, p, o): S-12.

A pattern is a tuple of three terms, each a constant or a variable that begins with '?'. All patterns are counted in one pass, joined from the rarest
outwards on the variables that they share, and variables that nothing needs any more are dropped with the repeats that this leaves: a customer of a
thousand matching orders is one row, not a thousand, in all later joins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PARTS = ("s", "p", "o")


def _variables(pattern: tuple) -> list[str]:
    return list(dict.fromkeys(t[1:] for t in pattern if t.startswith("?")))


def _condition(pattern: tuple):
    """Constants equal, and places of one variable equal to each other."""
    out, first = F.lit(True), {}
    for part, term in zip(PARTS, pattern, strict=True):
        if not term.startswith("?"):
            out = out & (F.col(part) == F.lit(term))
        elif term in first:
            out = out & (F.col(part) == F.col(first[term]))
        else:
            first[term] = part
    return out


def _bindings(triples: DataFrame, pattern: tuple) -> DataFrame:
    places = {t[1:]: part for part, t in reversed(list(zip(PARTS, pattern, strict=True))) if t.startswith("?")}
    return triples.where(_condition(pattern)).select(*[F.col(places[v]).alias(v) for v in _variables(pattern)])


def join_order(patterns: list[tuple], counts: list[int]) -> list[int]:
    """The rarest pattern first, then always the rarest of those that share a variable with what is joined."""
    rest, order, bound = set(range(len(patterns))), [], set()
    while rest:
        linked = [i for i in rest if not bound or bound & set(_variables(patterns[i])) or not _variables(patterns[i])]
        if not linked:
            raise ValueError("patterns that share no variable have no join")
        best = min(linked, key=lambda i: (counts[i], i))
        rest.remove(best)
        order.append(best)
        bound |= set(_variables(patterns[best]))
    return order


def match(triples: DataFrame, patterns: list[tuple], wanted: list[str]) -> DataFrame:
    """The distinct bindings of the wanted variables under which every pattern is a triple. A pattern without variables must exist."""
    unknown = set(wanted) - {v for p in patterns for v in _variables(p)}
    if unknown or not patterns:
        raise ValueError(f"no pattern binds {sorted(unknown)}")
    row = triples.agg(*[F.count_if(_condition(p)).alias(f"n{i}") for i, p in enumerate(patterns)]).first()
    counts = [row[f"n{i}"] for i in range(len(patterns))]
    order = join_order(patterns, counts)
    if 0 in counts:
        first = _bindings(triples, patterns[order[0]]).where(F.lit(False))
        return first.select(*[F.lit(None).cast("string").alias(v) for v in wanted])
    out = None
    for at, i in enumerate(order):
        names = _variables(patterns[i])
        if not names:
            continue  # a constant pattern that exists, as its count is not 0
        right = _bindings(triples, patterns[i])
        needed = set(wanted) | {v for j in order[at + 1 :] for v in _variables(patterns[j])}
        if out is None:
            out = right
        elif not set(names) - set(out.columns):
            out = out.join(right.distinct(), names, "left_semi")
        else:
            out = out.join(right, [n for n in names if n in out.columns])
        kept = [c for c in out.columns if c in needed]
        out = out.select(*kept).distinct() if len(kept) < len(out.columns) else out
    return out.select(*wanted).distinct()


def bindings_of(response, variables: list[str]):
    """Rows of a SPARQL JSON response as an array of structs with the variables' values; a variable that a row does not bind is null. Null for another shape."""
    parsed = F.from_json(response, "struct<results: struct<bindings: array<map<string, struct<value: string>>>>>")
    return F.transform(parsed["results"]["bindings"], lambda b: F.struct(*[b[v]["value"].alias(v) for v in variables]))
