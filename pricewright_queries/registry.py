"""Queries by name, each with the SQL that must give the same rows."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .views import with_views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None, views: str = ""):
    def register(function):
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = with_views(sql, *views.split())
        return function

    return register
