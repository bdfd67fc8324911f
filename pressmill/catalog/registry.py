"""Named queries over the given tables, each with the SQL that must agree with it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        key = name or function.__name__
        QUERIES[key] = function
        if sql is not None:
            ORACLE[key] = sql
        return function

    return register


_FIXTURES: dict[tuple[str, str, str], str] = {}


def fixture(make: Callable[[SparkSession, str, str], None]) -> Callable[[SparkSession, str], str]:
    """The folder that ``make(spark, sf_dir, folder)`` fills with files: once for each application and table folder."""

    def folder(spark: SparkSession, sf_dir: str) -> str:
        key = (spark.sparkContext.applicationId, sf_dir, make.__name__)
        if key not in _FIXTURES:
            path = scratch_path(spark, make.__name__)
            make(spark, sf_dir, path)
            _FIXTURES[key] = path
        return _FIXTURES[key]

    return folder
