"""Numbers with one notion of "missing": NULL.

Spark keeps NaN and NULL apart and lets NaN poison ``avg`` and ``stddev``, so
values are coerced once on the way in and every ratio yields NULL instead of
an error or an infinity.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


def number(value: Column | str) -> Column:
    """Double value; text that is no number, and NaN, become NULL."""
    as_double = _col(value).try_cast("double")
    return F.when(~F.isnan(as_double), as_double)


def ratio(numerator: Column, denominator: Column) -> Column:
    """``numerator / denominator``; NULL when the denominator is 0 or NULL."""
    return F.try_divide(numerator, denominator)


def growth(now: Column, before: Column) -> Column:
    """Relative change from ``before`` to ``now``."""
    return ratio(now, before) - F.lit(1.0)


def zero_as_null(value: Column) -> Column:
    return F.when(value != 0, value)


def finite(value: Column | str) -> Column:
    """True for a value that is neither NULL, NaN nor infinite."""
    v = _col(value).cast("double")
    return F.coalesce(v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))), F.lit(False))


def all_finite(names: list[str]) -> Column:
    """Row filter for training: every named column is finite."""
    return reduce(lambda a, b: a & b, [finite(n) for n in names])


def all_present(names: list[str]) -> Column:
    """Row filter for scoring: every named column is non-NULL; infinities pass."""
    return reduce(lambda a, b: a & b, [F.col(n).isNotNull() & ~F.isnan(F.col(n).cast("double")) for n in names])


def clip(value: Column, low: float, high: float) -> Column:
    """Limit to ``[low, high]``. NULL stays NULL (least/greatest would skip it)."""
    return F.when(value.isNotNull(), F.greatest(F.lit(float(low)), F.least(F.lit(float(high)), value)))


def truthy(condition: Column) -> Column:
    """A comparison with NULL counts as False."""
    return F.coalesce(condition, F.lit(False))


def log(value: Column) -> Column:
    """Natural log; NULL for values that have none."""
    return F.when(value > 0, F.ln(value))


def fill_zero(df: DataFrame, names: list[str]) -> DataFrame:
    """Rows without an event carry 0.0 instead of NULL; absent columns are added as 0.0."""
    present = set(df.columns)
    fills = {n: F.coalesce(number(n), F.lit(0.0)) if n in present else F.lit(0.0) for n in names}
    return df.withColumns(fills)


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value
