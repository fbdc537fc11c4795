"""The list of registered queries and of the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from medialoom.plans.bindings import Tables, with_views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, views: str = "", sql: str | None = None):
    """Register a function of the tables; ``sql`` may use the named views."""

    def register(function: Callable[[Tables], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return function(Tables(spark, folder))

        run.__name__ = name
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = chain(views, sql)
        return function

    return register


def chain(views: str, sql: str) -> str:
    """Views first; a query that starts with further WITH terms is continued."""
    text = sql.strip()
    if not views:
        return text
    if text.lower().startswith("with "):
        return with_views(views, "").rstrip() + ",\n" + text[5:]
    return with_views(views, text)
