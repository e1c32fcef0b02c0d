"""Registration of a query together with its SQL twin."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]


class Catalog:
    def __init__(self) -> None:
        self.queries: dict[str, Query] = {}
        self.oracles: dict[str, str] = {}

    def add(self, name: str, sql: str | None = None) -> Callable[[Query], Query]:
        def register(fn: Query) -> Query:
            if name in self.queries:
                raise ValueError(f"query {name} registered twice")
            self.queries[name] = fn
            if sql is not None:
                self.oracles[name] = sql
            return fn

        return register


def r6(col: Column | str) -> Column:
    """Six decimals: enough to compare engines that add doubles in another order."""
    col = F.col(col) if isinstance(col, str) else col
    return F.round(col.cast("double"), 6)


def rounded(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: r6(c) for c in cols})
