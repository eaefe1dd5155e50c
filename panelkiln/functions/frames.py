"""Row-framed windows over one entity's history.

A panel holds at most one row per (symbol, day), so a window group is never
longer than the calendar: about 37,000 rows for a century of daily data,
whatever the size of the table.

Frames end at the previous row (``-n .. -1``). That folds "roll, then lag by
one row" into a single window pass.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from panelkiln.functions.numeric import ratio


def history(order: str = "date", *keys: str) -> WindowSpec:
    return Window.partitionBy(*(keys or ("symbol",))).orderBy(order)


def before(w: WindowSpec, n: int) -> WindowSpec:
    """The ``n`` rows that precede the current one."""
    return w.rowsBetween(-n, -1)


def upto(w: WindowSpec, n: int) -> WindowSpec:
    """The current row and the ``n - 1`` rows before it."""
    return w.rowsBetween(-(n - 1), 0)


def pad(value: Column, w: WindowSpec) -> Column:
    """Carry the last known value forward."""
    return F.last(value, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))


def rolling(aggregate: Column, counted: Column, frame: WindowSpec, min_values: int) -> Column:
    """Aggregate over the frame when it holds ``min_values`` non-NULL values, else NULL."""
    return F.when(F.count(counted).over(frame) >= min_values, aggregate.over(frame))


def correlation(x: Column, y: Column) -> Column:
    """Pearson correlation of the complete pairs; NULL when a side is constant.

    ``corr`` raises a division error on a constant side under ANSI rules.
    """
    a, b = F.when(y.isNotNull(), x), F.when(x.isNotNull(), y)
    return ratio(F.covar_pop(a, b), F.stddev_pop(a) * F.stddev_pop(b))


def rolling_correlation(x: Column, y: Column, frame: WindowSpec, min_pairs: int) -> Column:
    a, b = F.when(y.isNotNull(), x), F.when(x.isNotNull(), y)
    spread = F.stddev_pop(a).over(frame) * F.stddev_pop(b).over(frame)
    value = ratio(F.covar_pop(a, b).over(frame), spread)
    return F.when(F.count(a).over(frame) >= min_pairs, value)


def _merged(older: Column, newer: Column, n: int, m: int, sums: Sequence[str], spreads: Sequence[str], pairs: Sequence[tuple[str, str]]) -> Column:
    """Sums and central moments of ``n`` rows and the ``m`` rows after them, from those of both."""
    weight = n * m / (n + m)
    apart = {c: newer[f"mean_{c}"] - older[f"mean_{c}"] for c in spreads}
    fields = [(older[f"sum_{c}"] + newer[f"sum_{c}"]).alias(f"sum_{c}") for c in sums]
    fields += [(older[f"mean_{c}"] + d * (m / (n + m))).alias(f"mean_{c}") for c, d in apart.items()]
    fields += [(older[f"square_{c}"] + newer[f"square_{c}"] + d * d * weight).alias(f"square_{c}") for c, d in apart.items()]
    fields += [(older[f"cross_{x}_{y}"] + newer[f"cross_{x}_{y}"] + apart[x] * apart[y] * weight).alias(f"cross_{x}_{y}") for x, y in pairs]
    return F.struct(*fields)


def trailing(
    df: DataFrame, w: WindowSpec, n: int, *, sums: Sequence[str], spreads: Sequence[str], pairs: Sequence[tuple[str, str]] = (), name: str
) -> DataFrame:
    """``df`` with a struct ``name`` of sums and moments over the ``n`` rows before the current; a field is NULL where a row or value is missing.

    Spark aggregates every sliding frame anew, all of its rows for each row and aggregate. Here the figures of 1, 2, 4, ... rows come
    from those of half as many by one lag each, so the work grows with the logarithm of the frame. Nothing is subtracted from
    running totals: moments are merged around their own means, and those of equal values are exactly zero. Fields are ``sum_{column}``,
    ``mean_`` and ``square_{column}`` (squared deviations) of ``spreads``, and ``cross_{x}_{y}`` of ``pairs`` of these.
    """
    own = [F.col(c).cast("double").alias(f"{kind}_{c}") for kind, names in (("sum", sums), ("mean", spreads)) for c in names]
    own += [F.when(F.col(c).isNotNull(), 0.0).alias(f"square_{c}") for c in spreads]
    own += [F.when(F.col(x).isNotNull() & F.col(y).isNotNull(), 0.0).alias(f"cross_{x}_{y}") for x, y in pairs]
    df = df.withColumn(f"{name}_1", F.struct(*own))
    parts, rows = [1 << i for i in range(n.bit_length()) if n >> i & 1], 1
    while 2 * rows <= n:
        df = df.withColumn(f"{name}_lag", F.lag(f"{name}_{rows}", rows).over(w))
        merged = _merged(F.col(f"{name}_lag"), F.col(f"{name}_{rows}"), rows, rows, sums, spreads, pairs)
        df = df.withColumn(f"{name}_{2 * rows}", merged).drop(f"{name}_lag", *([] if rows in parts else [f"{name}_{rows}"]))
        rows *= 2
    # The largest part ends one row back, each smaller one where the part after it begins.
    df = df.withColumns({f"{name}_{p}": F.lag(f"{name}_{p}", 1 + sum(q for q in parts if q > p)).over(w) for p in parts})
    older, n_older = f"{name}_{parts[0]}", parts[0]
    for p in parts[1:]:
        merged = _merged(F.col(older), F.col(f"{name}_{p}"), n_older, p, sums, spreads, pairs)
        df = df.withColumn(f"{name}_upto_{p}", merged).drop(older, f"{name}_{p}")
        older, n_older = f"{name}_upto_{p}", n_older + p
    return df.withColumnRenamed(older, name)


def mean_of(moments: str, column: str, n: int) -> Column:
    """Mean of one of the ``sums``."""
    return F.col(moments)[f"sum_{column}"] / n


def deviation_of(moments: str, column: str, n: int) -> Column:
    """Sample deviation of one of the ``spreads``."""
    return F.sqrt(F.col(moments)[f"square_{column}"] / (n - 1))


def correlation_of(moments: str, x: str, y: str, n: int) -> Column:
    """Pearson correlation of one of the ``pairs``; NULL when a side is constant."""
    m = F.col(moments)
    return ratio(m[f"cross_{x}_{y}"] / n, F.sqrt(m[f"square_{x}"] / n) * F.sqrt(m[f"square_{y}"] / n))
