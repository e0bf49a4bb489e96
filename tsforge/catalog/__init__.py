"""Registered queries and, where one exists, the SQL that must give the same rows."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
MODULES = ["alignment", "statistics", "labelling", "scoring", "decisions", "intake", "jobs"]


def load() -> tuple[dict[str, Query], dict[str, str]]:
    queries: dict[str, Query] = {}
    oracles: dict[str, str] = {}
    for name in MODULES:
        module = importlib.import_module(f"tsforge.catalog.{name}")
        for key, (fn, sql) in module.ENTRIES.items():
            if key in queries:
                raise ValueError(f"duplicate query {key}")
            queries[key] = fn
            if sql is not None:
                oracles[key] = sql.strip()
    return queries, oracles


class Registry(dict):
    """Collects entries with ``@entry(sql=...)``."""

    def entry(self, sql: str | None = None, name: str | None = None):
        def wrap(fn: Query) -> Query:
            self[name or fn.__name__] = (fn, sql)
            return fn

        return wrap
