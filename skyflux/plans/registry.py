"""The engine's named queries over the driver's tables, and their SQL twins.

events stands for observations: user_id is a satellite's series, ts its time (unique), value its measurement, event_type its constellation."""

from __future__ import annotations

from . import queries_receiver, queries_scalar, queries_series, queries_tables

FLAGSHIP = "s4_by_bin"
_PARTS = (queries_scalar, queries_series, queries_tables, queries_receiver)


def queries() -> dict:
    return {name: q for part in _PARTS for name, (q, _) in part.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for part in _PARTS for name, (_, sql) in part.QUERIES.items() if sql}
