"""Lagged price, volume and market features per (symbol, day)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from panelkiln.functions.columns import price_column, require
from panelkiln.functions.frames import correlation_of, deviation_of, history, mean_of, pad, trailing
from panelkiln.functions.numeric import growth, log, number, ratio, zero_as_null
from panelkiln.operators.labels import forward_return
from panelkiln.operators.rows import attach_daily

WINDOW_ROWS = 20


def priced_rows(prices: DataFrame, adjusted: bool) -> DataFrame:
    """Typed (symbol, date, px, high, low, volume) rows; absent optional columns are NULL."""
    require(prices, "symbol", "date", "close")
    optional = {c: number(c) if c in prices.columns else F.lit(None).cast("double") for c in ("high", "low", "volume")}
    return prices.select(
        "symbol",
        F.to_date("date").alias("date"),
        number(price_column(prices, adjusted)).alias("px"),
        *[value.alias(name) for name, value in optional.items()],
    )


def market_price(rows: DataFrame) -> DataFrame:
    """Mean price per day over every priced symbol, members or not."""
    return rows.groupBy("date").agg(F.avg("px").alias("mkt_px"))


def build_price_features(
    prices: DataFrame,
    *,
    adjusted: bool = False,
    lookbacks: Sequence[int] = (1, 5, 20, 60, 120),
    include_raw_return: bool = False,
    label_horizon: int | None = None,
) -> DataFrame:
    """Features usable on ``decision_date``, each computed from earlier rows only.

    ``prices`` is keyed by (symbol, date). One shuffle by symbol serves every
    window; frames that end one row back replace a separate lag. The first row
    of a symbol has no earlier row and is dropped. ``include_raw_return`` adds
    the same-day return ``ret_1d_raw``, which is look-ahead for a decision taken
    that day, and is therefore off unless asked for.

    With ``label_horizon`` the forward return is taken in the same pass and rows
    without one are dropped: the same rows as joining ``build_labels``, without
    shuffling both sides by (day, symbol).
    """
    rows = priced_rows(prices, adjusted)
    dated = attach_daily(rows, market_price(rows), "date")
    return features_of_rows(dated, lookbacks=lookbacks, include_raw_return=include_raw_return, label_horizon=label_horizon)


#: Rows before a day that its features look at, whatever the lookbacks: 20 market returns, the first from two rows before.
LEAST_TAIL = 22


def tail_rows(lookbacks: Sequence[int]) -> int:
    """How many of a symbol's rows before a day its features depend on, given padded prices."""
    return max(LEAST_TAIL, *(k + 1 for k in lookbacks))


def padded_rows(dated: DataFrame) -> DataFrame:
    """``priced_rows`` with ``mkt_px``, and with both prices carried forward as ``_p`` and ``_m``; known ones of earlier rows are kept."""
    w = history("date")
    known = {c: F.coalesce(c, F.col(px)) if c in dated.columns else F.col(px) for c, px in (("_p", "px"), ("_m", "mkt_px"))}
    return dated.withColumns({c: pad(value, w) for c, value in known.items()})


def features_of_rows(
    dated: DataFrame, *, lookbacks: Sequence[int], include_raw_return: bool = False, label_horizon: int | None = None
) -> DataFrame:
    """``build_price_features`` from ``priced_rows`` that have their day's market price."""
    w = history("date")
    padded = padded_rows(dated)

    def price(k: int):
        return F.lag("_p", k).over(w)

    def market(k: int):
        return F.lag("_m", k).over(w)

    returns = padded.withColumns(
        {
            **{f"ret_{k}d": growth(price(1), price(k + 1)) for k in lookbacks},
            "feature_available_date": F.lag("date", 1).over(w),
            "ret_1d_raw": growth(F.col("_p"), price(1)),
            "_mkt_ret": growth(market(1), market(2)),
            "_range": ratio(F.col("high") - F.col("low"), zero_as_null(F.col("px"))),
            "_vol": zero_as_null(F.col("volume")),
            "_prev_vol": zero_as_null(F.lag("volume", 1).over(w)),
        }
    ).withColumns({"_logret": log(F.col("ret_1d_raw") + 1.0), "_dollar": F.col("_vol") * F.col("px")})

    label = {}
    if label_horizon is not None:
        label = forward_return("date", "px", w, label_horizon)
    returns = returns.withColumns(label)
    # A pair counts where both returns are there.
    sides = {"_own": "ret_1d_raw", "_market": "_mkt_ret"}
    whole = F.col("ret_1d_raw").isNotNull() & F.col("_mkt_ret").isNotNull()
    returns = returns.withColumns({name: F.when(whole, F.col(c)) for name, c in sides.items()})
    fields = {"sums": ["_vol", "_range", "_dollar"], "spreads": ["_vol", "_logret", *sides], "pairs": [tuple(sides)]}
    vol_spread = deviation_of("_last20", "_vol", WINDOW_ROWS) + F.lit(1e-12)
    features = trailing(returns, w, WINDOW_ROWS, **fields, name="_last20").withColumns(
        {
            "corr_mkt_20d": correlation_of("_last20", *sides, WINDOW_ROWS),
            "vol_20d": deviation_of("_last20", "_logret", WINDOW_ROWS),
            "range_20d": mean_of("_last20", "_range", WINDOW_ROWS),
            "adv20_dollar": mean_of("_last20", "_dollar", WINDOW_ROWS),
            "volume_z_20d": ratio(F.col("_prev_vol") - mean_of("_last20", "_vol", WINDOW_ROWS), vol_spread),
        }
    )
    names = [f"ret_{k}d" for k in lookbacks]
    if include_raw_return:
        names.append("ret_1d_raw")
    names += ["corr_mkt_20d", "vol_20d", "range_20d", "adv20_dollar", "volume_z_20d"]
    if {20, 60} <= set(lookbacks):
        features = features.withColumn("mom_20_60", F.col("ret_20d") - F.col("ret_60d"))
        names.append("mom_20_60")
    if label:
        features = features.dropna(subset=[c for c in label if c != "horizon"])
    return features.filter(F.col("feature_available_date").isNotNull()).select(
        F.col("date").alias("decision_date"), "symbol", *names, "feature_available_date", *label
    )
