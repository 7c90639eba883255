"""Registered queries and their DuckDB counterparts, by the operator's ID."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quotemill.sources.views import oracle

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(f: Query) -> Query:
        QUERIES[name] = f
        if sql is not None:
            ORACLES[name] = oracle(sql)
        return f

    return register


def r(c: Column | str, digits: int = 6) -> Column:
    """Rounded for comparison: sums depend on the order of their rows in the last bits."""
    return F.round(F.col(c) if isinstance(c, str) else c, digits) + F.lit(0.0)  # no negative zero


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    return df.select(*[r(c, digits).alias(c) if t in ("double", "float") else F.col(c) for c, t in df.dtypes])


def us(df: DataFrame, *names: str) -> DataFrame:
    """Timestamps as microseconds of the epoch, which no session's time zone changes."""
    return df.withColumns({n: F.unix_micros(n) for n in names})
