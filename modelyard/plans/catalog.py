"""All registered queries and their check SQL."""

from __future__ import annotations

from modelyard.plans import discovery, merging, reporting, scoring, training

_PARTS = [discovery, merging, scoring, training, reporting]


def queries() -> dict:
    return {name: query for part in _PARTS for name, query in part.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for part in _PARTS for name, sql in part.ORACLE.items()}
