"""The list of registered queries."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from .inputs import spark_table, with_tables

Tables = Callable[[str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


QUERIES: dict[str, Query] = {}


def query(tables: str = "", sql: str | None = None, name: str | None = None):
    """Register ``fn(t)``, where ``t(name)`` gives an input table as a DataFrame.

    ``tables`` names the derived tables that ``sql`` uses.
    """

    def register(fn: Callable[[Tables], DataFrame]):
        key = name or fn.__name__

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(lambda table: spark_table(spark, sf_dir, table))

        text = None if sql is None else (with_tables(tables, sql) if tables else sql)
        QUERIES[key] = Query(key, run, text)
        return fn

    return register
