"""How queries are bound to the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


class Plans:
    """A group of queries and their SQL."""

    def __init__(self):
        self.queries: dict[str, Query] = {}
        self.sql: dict[str, str] = {}

    def add(self, sql: str | None = None, name: str | None = None):
        def take(f: Query) -> Query:
            key = name or f.__name__
            self.queries[key] = f
            if sql is not None:
                self.sql[key] = sql
            return f

        return take
