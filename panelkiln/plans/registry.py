"""Registered queries, each next to the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; without SQL only its rows can be checked."""

    def register(function: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query registered twice: {name}")
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


def rounded(df: DataFrame, digits: int = 6, **special: int) -> DataFrame:
    """Doubles rounded, so sums taken in another order compare equal."""
    doubles = {name for name, kind in df.dtypes if kind == "double"}
    # Adding 0.0 turns a negative zero into zero.
    return df.select(
        [
            (F.round(c, special.get(c, digits)) + F.lit(0.0)).alias(c) if c in doubles else F.col(c)
            for c in df.columns
        ]
    )


def counted(name: str) -> Column:
    return F.count(F.lit(1)).alias(name)
