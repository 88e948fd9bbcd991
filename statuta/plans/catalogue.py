"""All queries of the engine's own operators, with their oracle SQL."""

from __future__ import annotations

from . import layouts, pages, provisions, scalars, structures, tables

#: Modules that add queries to those of `tables`.
MORE = (layouts, pages, provisions, structures)


def queries() -> dict:
    return tables.queries() | scalars.queries()


def oracle_sql() -> dict:
    return tables.oracle_sql() | scalars.oracle_sql()
