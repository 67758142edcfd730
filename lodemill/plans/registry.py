"""Queries by name, each beside the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import table

Tables = Callable[[str], DataFrame]


class Registry:
    """Collects queries; a query gets a function that reads a corpus table by name."""

    def __init__(self) -> None:
        self.queries: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
        self.sql: dict[str, str] = {}

    def __call__(self, name: str, sql: str | None = None) -> Callable:
        def add(make: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
            def run(spark: SparkSession, root: str) -> DataFrame:
                def read(table_name: str) -> DataFrame:
                    return table(spark, root, table_name)

                return make(read)

            run.__name__, run.__doc__ = name, make.__doc__
            self.queries[name] = run
            if sql:
                self.sql[name] = sql
            return make

        return add
