"""Queries over the driver's tables, each with its ANSI SQL counterpart."""

from __future__ import annotations

from . import captures, gold, lines, matching, reports, weather

_ALL = {}
for _part in (captures, lines, matching, gold, weather, reports):
    _ALL.update(_part.QUERIES)


def queries() -> dict:
    return {name: entry[0] for name, entry in _ALL.items()}


def oracle_sql() -> dict:
    return {name: entry[1] for name, entry in _ALL.items() if entry[1] is not None}
