"""Registration of queries together with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def with_tables(ctes: dict[str, str], names: str, body: str) -> str:
    """Prefix body with the named table definitions, in the given order."""
    parts = ",\n".join(f"{n} AS ({ctes[n].strip()})" for n in names.split())
    joiner = ",\n" if body.lstrip().upper().startswith("WITH ") else "\n"
    body = body.lstrip()
    if joiner == ",\n":
        body = body[5:]
    return f"WITH {parts}{joiner}{body}"
