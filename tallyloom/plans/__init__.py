"""Named queries over the standard tables, each with the SQL that another engine can run."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function under its own name, with its SQL if there is one."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return add


def load() -> None:
    """Import the modules that register queries."""
    from tallyloom.plans import bank, customers, documents, fixtures, scalars, values  # noqa: F401
