"""Collects (query, SQL) pairs and the rounding both sides share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

# Sums differ in the last bits with their order. A nudge far below the kept digits moves
# exact ties off the rounding edge, the same way in both engines.
NUDGE = 1e-9


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"{name} registered twice")
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return register


def r(c: Column | str, digits: int = 4) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c + NUDGE, digits)


def rounded(df: DataFrame, *names: str, digits: int = 4) -> DataFrame:
    return df.withColumns({n: r(n, digits) for n in names})


def q(expr: str, digits: int = 4) -> str:
    """SQL form of :func:`r`."""
    return f"round(({expr}) + {NUDGE}, {digits})"
