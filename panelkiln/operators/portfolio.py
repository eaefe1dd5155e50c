"""Cost-aware top-N portfolios from daily predictions.

A day's target weights depend only on that day's predictions, so the weights
before a rebalance are simply those of the rebalance before it. Days are
therefore independent until the equity curve, which runs over one row per day.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from panelkiln.functions.dates import iso_week
from panelkiln.functions.numeric import finite, number, ratio
from panelkiln.operators.metrics import sharpe, with_drawdown
from panelkiln.operators.rows import attach_daily, top_rows
from panelkiln.session import stored

# Stands in for an unknown or zero traded value: trading it moves no price.
UNKNOWN_LIQUIDITY = 1e12


@dataclass(frozen=True)
class PortfolioRules:
    topn: int = 50
    max_names: int = 50
    long_short: bool = False
    single_name_cap: float = 0.05
    rebalance: str = "daily"
    commission_bps: float = 1.0
    slippage_base_bps: float = 1.0
    slippage_k_adv: float = 10.0
    slippage_k_vol: float = 1.0
    notional: float = 1_000_000.0

    def __post_init__(self) -> None:
        if self.rebalance not in ("daily", "weekly"):
            raise ValueError(f"unsupported rebalance mode: {self.rebalance}")
        if self.topn < 1 or self.max_names < 1:
            raise ValueError("topn and max_names must be positive")


def usable_predictions(preds: DataFrame) -> DataFrame:
    """Typed predictions with a score and an outcome; missing cost columns are NULL."""

    def optional(name: str) -> Column:
        return number(name) if name in preds.columns else F.lit(None).cast("double")

    return preds.select(
        F.to_date("decision_date").alias("date"),
        "symbol",
        number("y_pred").alias("y_pred"),
        number("y_true").alias("y_true"),
        optional("adv20_dollar").alias("adv"),
        optional("vol_20d").alias("vol"),
    ).dropna(subset=["y_pred", "y_true"])


def schedule(rows: DataFrame, mode: str) -> DataFrame:
    """One row per day: its number of names, whether it rebalances, and the rebalance in force."""
    days = rows.groupBy("date").agg(F.count(F.lit(1)).alias("names"))
    week = Window.partitionBy(iso_week(F.col("date"))).orderBy("date")
    rebalances = F.lit(True) if mode == "daily" else F.row_number().over(week) == 1
    in_order = Window.orderBy("date").rowsBetween(Window.unboundedPreceding, 0)
    return days.withColumn("rebalances", rebalances).withColumn("turn", F.count_if("rebalances").over(in_order))


def target_positions(rows: DataFrame, days: DataFrame, rules: PortfolioRules) -> DataFrame:
    """Positions taken on each rebalance day, with their weights."""
    chosen = attach_daily(rows, days.filter("rebalances").select("date", "names", "turn"), "date", "inner")
    most_longs = min(rules.topn, rules.max_names)
    n_long = F.least(F.lit(most_longs), F.col("names"))
    n_short = F.least(F.lit(rules.topn), F.lit(rules.max_names) - n_long, F.col("names") - n_long)
    best_first = [F.col("y_pred").desc(), F.col("symbol").asc()]
    worst_first = [F.col("y_pred").asc(), F.col("symbol").desc()]
    salt = F.col("symbol")

    longs = top_rows(chosen, "date", best_first, most_longs, salt)
    if not rules.long_short:
        # Equal weights: capping them and rescaling to 1 gives equal weights again.
        return longs.withColumn("weight", F.lit(1.0) / n_long).drop("rn", "names")

    cap = F.lit(float(rules.single_name_cap))
    long_size = F.least(F.lit(1.0) / n_long, cap)
    short_size = F.when(n_short > 0, F.least(ratio(F.lit(1.0), n_short.cast("double")), cap)).otherwise(0.0)
    gross = n_long * long_size + n_short * short_size
    # With a cap of 0 all weights are 0 and there is nothing to scale.
    scale = F.when(gross > 0, gross).otherwise(1.0)
    longs = longs.withColumn("weight", long_size / scale)
    shorts = (
        top_rows(chosen, "date", worst_first, rules.topn, salt)
        .filter(F.col("rn") <= n_short)
        .withColumn("weight", -short_size / scale)
    )
    return longs.unionByName(shorts).drop("rn", "names")


def trades(positions: DataFrame, rules: PortfolioRules) -> DataFrame:
    """Per rebalance: turnover against the one before, names held, price impact of the trades.

    Each position counts once for its own rebalance and once, as the weight to
    trade away from, for the next.
    """
    zero = F.lit(0.0)
    now = positions.select("turn", "symbol", F.col("weight").alias("w"), zero.alias("w_prev"), "adv")
    then = positions.select(
        (F.col("turn") + 1).alias("turn"), "symbol", zero.alias("w"), F.col("weight").alias("w_prev"),
        F.lit(None).cast("double").alias("adv"),
    )
    change = F.abs(F.col("w") - F.col("w_prev"))
    held = F.col("w") != 0
    liquidity = F.when(F.col("adv") != 0, F.col("adv")).otherwise(F.lit(UNKNOWN_LIQUIDITY))
    impact = change * F.lit(float(rules.notional)) / liquidity
    return (
        now.unionByName(then)
        .groupBy("turn", "symbol")
        .agg(F.sum("w").alias("w"), F.sum("w_prev").alias("w_prev"), F.max("adv").alias("adv"))
        .groupBy("turn")
        .agg(
            (F.sum(change) / 2.0).alias("turnover"),
            F.count_if(held).alias("held"),
            F.coalesce(F.avg(F.when(held & finite(impact), impact)), zero).alias("impact_adv"),
        )
    )


def daily_positions(rows: DataFrame, days: DataFrame, positions: DataFrame, rules: PortfolioRules) -> DataFrame:
    """Positions that earn on each day; between rebalances those still in the cross-section, at old weights."""
    if rules.rebalance == "daily":
        return positions
    weights = positions.select("turn", "symbol", "weight")
    return attach_daily(rows, days.select("date", "turn"), "date", "inner").join(weights, ["turn", "symbol"])


def run_portfolio(preds: DataFrame, rules: PortfolioRules = PortfolioRules()) -> tuple[DataFrame, DataFrame]:
    """(daily, positions) of the portfolio.

    The schedule (a row per day) and the targets (at most ``max_names`` rows per
    rebalance) are stored once, as each is needed several times; the large
    prediction table should be a stored table too.
    """
    rows = usable_predictions(preds)
    days = stored(schedule(rows, rules.rebalance), "schedule")
    targets = stored(target_positions(rows, days, rules), "targets")
    held = daily_positions(rows, days, targets, rules)

    vol = F.coalesce("vol", F.lit(0.0))
    per_day = held.groupBy("date", "turn").agg(
        F.sum(F.col("weight") * F.col("y_true")).alias("gross_return"),
        F.count(F.lit(1)).alias("n_names"),
        F.sum(F.when(finite(vol), vol)).alias("vol_sum"),
        F.count_if(~finite(vol)).alias("vol_bad"),
    )
    # All tables below have one row per day or per rebalance.
    flags = days.select("date", "rebalances")
    traded = F.col("rebalances").cast("double")
    absent_count_as_calm = F.coalesce(
        ratio(F.col("vol_sum"), (F.col("held") - F.col("vol_bad")).cast("double")), F.lit(0.0)
    )
    slip_bps = (
        F.lit(float(rules.slippage_base_bps))
        + F.lit(float(rules.slippage_k_adv)) * F.col("impact_adv") * traded
        + F.lit(float(rules.slippage_k_vol)) * absent_count_as_calm
    )
    daily = (
        per_day.join(flags, "date")
        .join(trades(targets, rules), "turn")
        .withColumns({"slip_bps_est": slip_bps, "turnover": F.col("turnover") * traded})
        .withColumns(
            {
                "commission": F.lit(rules.commission_bps / 10000.0) * F.col("turnover"),
                "slippage": F.col("slip_bps_est") / 10000.0 * F.col("turnover"),
            }
        )
        .withColumn("cost_total", F.col("commission") + F.col("slippage"))
        .withColumn("net_return", F.col("gross_return") - F.col("cost_total"))
        .select(
            "date", "gross_return", "net_return", "turnover", "commission", "slippage", "cost_total",
            "n_names", "slip_bps_est",
        )
    )
    positions = held.select("date", "symbol", "weight", "y_pred", "y_true")
    return with_drawdown(daily), positions


def portfolio_summary(daily: DataFrame) -> DataFrame:
    """One row of figures; days = 0 and NULLs when nothing could be traded."""
    return daily.agg(
        F.count(F.lit(1)).alias("days"),
        sharpe("net_return").alias("sharpe"),
        F.min("drawdown").alias("max_drawdown"),
        F.avg("turnover").alias("avg_turnover"),
        F.avg("cost_total").alias("avg_cost"),
        (F.max_by("equity", "date") - 1.0).alias("total_return"),
    )
