"""Forward-return labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, WindowSpec, functions as F

from panelkiln.functions.columns import price_column, require
from panelkiln.functions.frames import history
from panelkiln.functions.numeric import growth, number


def forward_return(date: str, price: str, w: WindowSpec, horizon: int) -> dict[str, Column]:
    """Columns label_date, future_return_{horizon}d and horizon, looking ``horizon`` rows ahead."""
    if horizon < 1:
        raise ValueError("horizon must be >= 1")
    ahead = F.lead(price, horizon).over(w)
    return {
        "label_date": F.lead(date, horizon).over(w),
        f"future_return_{horizon}d": growth(ahead, F.col(price)),
        "horizon": F.lit(horizon),
    }


def build_labels(prices: DataFrame, *, horizon: int, adjusted: bool = False) -> DataFrame:
    """Return from each row to the symbol's ``horizon``-th next row; rows without one are dropped."""
    require(prices, "symbol", "date", "close")
    label = forward_return("date", "px", history("date"), horizon)
    return (
        prices.select(
            "symbol",
            F.to_date("date").alias("decision_date"),
            F.to_date("date").alias("date"),
            number(price_column(prices, adjusted)).alias("px"),
        )
        .withColumns(label)
        .select("decision_date", "label_date", "symbol", *[c for c in label if c != "label_date"])
        .dropna(subset=[c for c in label if c != "horizon"])
    )


def label_summary(labels: DataFrame, target: str) -> DataFrame:
    """One row: label count and the share without a value."""
    missing = F.col(target).isNull() | F.isnan(target)
    return labels.agg(
        F.count(F.lit(1)).alias("rows"), F.avg(missing.cast("double")).alias("nan_ratio")
    )
