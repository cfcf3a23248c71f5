"""Names of queries, their functions and their SQL."""

from __future__ import annotations

_found: dict = {}
_sql: dict = {}


def query(name: str, sql: str | None = None):
    def keep(f):
        _found[name] = f
        if sql:
            _sql[name] = sql
        return f

    return keep


def queries() -> dict:
    from corvane.plans import curation, linkage, loading, measures, populations, records, reports, scans, tagging  # noqa: F401  they register their queries

    return dict(_found)


def oracle_sql() -> dict[str, str]:
    queries()
    return dict(_sql)
