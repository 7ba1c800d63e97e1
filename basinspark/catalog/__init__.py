"""Registered queries over the test tables, each with its SQL counterpart where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFunction = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFunction] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[QueryFunction], QueryFunction]:
    """Register a function under its name, with the SQL that gives the same rows."""

    def register(function: QueryFunction) -> QueryFunction:
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLES[function.__name__] = sql
        return function

    return register


def load_all() -> None:
    """Import the query modules, which registers their queries."""
    from basinspark.catalog import calendars, ensembles, flows, grids, joins, models, records, skills, storage  # noqa: F401
