"""Prediction quality: daily information coefficients and return-series figures."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from panelkiln.functions.frames import correlation
from panelkiln.functions.numeric import finite, number, ratio
from panelkiln.operators.rows import RANGE_ROWS, with_ranks
from panelkiln.session import stored

MIN_NAMES = 3
TRADING_DAYS = 252


def _pairs(preds: DataFrame, keys: Sequence[str], score: str, label: str) -> DataFrame:
    return preds.select(*keys, number(score).alias("_s"), number(label).alias("_y")).dropna(subset=["_s", "_y"])


def daily_ic(
    preds: DataFrame, *, keys: Sequence[str] = ("decision_date",), score: str = "y_pred", label: str = "y_true"
) -> DataFrame:
    """Pearson correlation of score and label per day (and further keys), on at least 3 names."""
    return (
        _pairs(preds, keys, score, label)
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("n"), correlation(F.col("_s"), F.col("_y")).alias("ic"))
        .filter((F.col("n") >= MIN_NAMES) & finite("ic"))
    )


def daily_rank_ic(
    preds: DataFrame,
    *,
    keys: Sequence[str] = ("decision_date",),
    score: str = "y_pred",
    label: str = "y_true",
    range_rows: int = RANGE_ROWS,
) -> DataFrame:
    """Spearman correlation per day (and further keys), ties ranked by their average.

    Both ranks are formed over value ranges of each day (``with_ranks``), so a day that holds
    every row, or one value that all its rows share, is no burden to one task.
    """
    pairs = stored(_pairs(preds, keys, score, label).select(F.struct(*keys).alias("_day"), "_s", "_y"), "pairs")
    ranked = with_ranks(pairs, "_day", ["_s", "_y"], range_rows)
    # Ranks of N names average (N + 1) / 2, so centred sums need no second pass.
    middle = (F.col("group_size") + 1) / 2.0
    a, b = F.col("_s_rank") - middle, F.col("_y_rank") - middle
    spread = F.sqrt(F.sum(a * a)) * F.sqrt(F.sum(b * b))
    return (
        ranked.groupBy("_day")
        .agg(F.count(F.lit(1)).alias("n"), ratio(F.sum(a * b), spread).alias("ic"))
        .filter((F.col("n") >= MIN_NAMES) & finite("ic"))
        .select("_day.*", "n", "ic")
    )


def series_summary(value: Column | str) -> list[Column]:
    """Aggregates n, mean and sample std; the std of one value is 0, of none NULL."""
    v = F.col(value) if isinstance(value, str) else value
    spread = F.when(F.count(v) > 1, F.stddev_samp(v)).when(F.count(v) == 1, F.lit(0.0))
    return [F.count(v).alias("n"), F.avg(v).alias("mean"), spread.alias("std")]


def evaluate_predictions(preds: DataFrame) -> DataFrame:
    """Per (model_name, split): summary of the daily rank IC and IC, with the daily series."""
    keys = ("model_name", "split", "decision_date")
    both = daily_rank_ic(preds, keys=keys).withColumn("kind", F.lit("rank_ic")).unionByName(
        daily_ic(preds, keys=keys).withColumn("kind", F.lit("ic"))
    )
    # A series has one entry per day, so its length is bounded by the calendar.
    series = F.transform(
        F.array_sort(F.collect_list(F.struct("decision_date", "ic"))), lambda e: e["ic"]
    )
    return both.groupBy("model_name", "split", "kind").agg(*series_summary("ic"), series.alias("daily"))


def sharpe(value: Column | str, annualization: int = TRADING_DAYS) -> Column:
    """Aggregate: mean over sample std, annualised; NULL for fewer than 2 values or no spread."""
    v = F.col(value) if isinstance(value, str) else value
    return ratio(F.avg(v), F.stddev_samp(v)) * F.lit(math.sqrt(annualization))


def with_drawdown(daily: DataFrame, *, keys: Sequence[str] = (), on: str = "date") -> DataFrame:
    """Equity and drawdown of a daily ``net_return`` table, one row per day and key."""
    w = Window.partitionBy(*keys).orderBy(on).rowsBetween(Window.unboundedPreceding, 0)
    return daily.withColumn("equity", F.product(F.col("net_return") + F.lit(1.0)).over(w)).withColumn(
        "drawdown", ratio(F.col("equity"), F.max("equity").over(w)) - F.lit(1.0)
    )


def mean_squared_error(scored: DataFrame, prediction: str = "y_pred", label: str = "y_true") -> DataFrame:
    return scored.agg(F.avg(F.pow(F.col(prediction) - F.col(label), 2)).alias("mse"))
