"""Where the catalogue's modules enter their queries."""

from __future__ import annotations

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Enter a function (spark, folder) -> DataFrame under a name, with the SQL it is checked against."""

    def keep(f):
        if name in QUERIES:
            raise ValueError(f"{name} is taken")
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return keep
