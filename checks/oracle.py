"""Oracle SQL of every query that SQL can express, ready to run."""

from __future__ import annotations

from checks import queries_events, queries_flows, queries_relational, queries_warehouse
from checks.views import with_views

RAW = {**queries_relational.SQL, **queries_events.SQL, **queries_warehouse.SQL, **queries_flows.SQL}


def oracle_sql() -> dict[str, str]:
    return {name: with_views(sql) for name, sql in RAW.items()}
