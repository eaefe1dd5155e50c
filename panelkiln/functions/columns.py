"""Choosing among alias columns of loosely typed vendor tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from panelkiln.functions.numeric import number


def first_present(df: DataFrame, candidates: Sequence[str]) -> str | None:
    """Name of the first candidate column that the table has."""
    return next((c for c in candidates if c in df.columns), None)


def first_value(
    df: DataFrame, candidates: Sequence[str], read: Callable[[str], Column] = F.col, data_type: str = "string"
) -> Column:
    """Per row, the first candidate that holds a value once read."""
    found = [read(c) for c in candidates if c in df.columns]
    return F.coalesce(*found) if found else F.lit(None).cast(data_type)


def first_with_data(df: DataFrame, candidates: Sequence[str]) -> str | None:
    """First candidate column with any numeric value, decided for the whole table in one pass."""
    names = [c for c in candidates if c in df.columns]
    if not names:
        return None
    found = df.agg(*[F.bool_or(number(c).isNotNull()).alias(f"c{i}") for i, c in enumerate(names)]).first()
    return next((c for c, holds in zip(names, found) if holds), None)


def price_column(prices: DataFrame, adjusted: bool) -> str:
    """``adj_close`` when wanted and the table has any, else ``close``."""
    if adjusted and first_with_data(prices, ["adj_close"]):
        return "adj_close"
    return "close"


def symbol_name(value: Column | str) -> Column:
    c = F.col(value) if isinstance(value, str) else value
    return F.upper(F.trim(c.cast("string")))


def require(df: DataFrame, *names: str) -> DataFrame:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    return df
