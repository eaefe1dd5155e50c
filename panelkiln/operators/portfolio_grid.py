"""Many portfolio rules over the same predictions in one plan.

The predictions are ranked once, to the greatest N of any rule; what each rule holds are then
the first rows of that ranking, so rules multiply rows only behind the cut. Rules
are values of a column: schedules, weights, costs and equity curves of all of them come from the same few aggregates.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import fields

from pyspark.sql import Column, DataFrame, functions as F

from panelkiln.functions.numeric import finite, ratio
from panelkiln.operators.metrics import sharpe, with_drawdown
from panelkiln.operators.portfolio import UNKNOWN_LIQUIDITY, PortfolioRules, schedule, usable_predictions
from panelkiln.operators.rows import attach_daily, top_rows
from panelkiln.session import stored


def _literal(name: str, rules: PortfolioRules) -> Column:
    """A rule as a struct; all numbers of a field have one type."""
    kinds = {"int": "long", "float": "double", "bool": "boolean", "str": "string"}
    values = [F.lit(getattr(rules, f.name)).cast(kinds[str(f.type)]).alias(f.name) for f in fields(PortfolioRules)]
    return F.struct(F.lit(name).alias("name"), *values, F.lit(min(rules.topn, rules.max_names)).cast("long").alias("most_longs"))


def _targets(rows: DataFrame, days: DataFrame, rules: Mapping[str, PortfolioRules]) -> DataFrame:
    """Positions taken on each rule's rebalance days: rule, turn, date, symbol, weight and the row's figures."""
    names = days.where("mode = 'daily'").select("date", "names")
    ranked = attach_daily(rows, names, "date", "inner")
    best_first, worst_first = [F.col("y_pred").desc(), F.col("symbol").asc()], [F.col("y_pred").asc(), F.col("symbol").desc()]
    salt = F.col("symbol")
    longs = top_rows(ranked, "date", best_first, max(min(r.topn, r.max_names) for r in rules.values()), salt).withColumn("side", F.lit(1))
    both = [r.topn for r in rules.values() if r.long_short]
    if both:
        longs = longs.unionByName(top_rows(ranked, "date", worst_first, max(both), salt).withColumn("side", F.lit(-1)))
    ranked = stored(longs, "ranked")
    each = ranked.withColumn("r", F.explode(F.array(*[_literal(name, r) for name, r in rules.items()])))
    n_long = F.least("r.most_longs", "names")
    n_short = F.least(F.col("r.topn"), F.col("r.max_names") - n_long, F.col("names") - n_long)
    held = F.when(F.col("side") == 1, F.col("rn") <= n_long).otherwise(F.col("r.long_short") & (F.col("rn") <= n_short))
    cap = F.col("r.single_name_cap")
    long_size = F.least(F.lit(1.0) / n_long, cap)
    short_size = F.when(n_short > 0, F.least(ratio(F.lit(1.0), n_short.cast("double")), cap)).otherwise(0.0)
    gross = n_long * long_size + n_short * short_size
    scale = F.when(gross > 0, gross).otherwise(1.0)
    sided = F.when(F.col("side") == 1, long_size).otherwise(-short_size) / scale
    weight = F.when(F.col("r.long_short"), sided).otherwise(F.lit(1.0) / n_long)
    taken = each.where(held).select("date", F.col("r.name").alias("rule"), F.col("r.rebalance").alias("mode"), "symbol", weight.alias("weight"), "y_pred", "y_true", "adv", "vol")
    turns = days.where("rebalances").select("mode", "date", "turn")
    return taken.join(F.broadcast(turns), ["mode", "date"])  # two rows a day at most: the calendar bounds them


def _trades(targets: DataFrame, settings: DataFrame) -> DataFrame:
    """Per rule and rebalance: turnover against the one before, names held, price impact."""
    zero = F.lit(0.0)
    now = targets.select("rule", "turn", "symbol", F.col("weight").alias("w"), zero.alias("w_prev"), "adv")
    then = targets.select("rule", (F.col("turn") + 1).alias("turn"), "symbol", zero.alias("w"), F.col("weight").alias("w_prev"), F.lit(None).cast("double").alias("adv"))
    change, held = F.abs(F.col("w") - F.col("w_prev")), F.col("w") != 0
    impact = change * F.col("notional") / F.when(F.col("adv") != 0, F.col("adv")).otherwise(F.lit(UNKNOWN_LIQUIDITY))
    legs = now.unionByName(then).groupBy("rule", "turn", "symbol").agg(F.sum("w").alias("w"), F.sum("w_prev").alias("w_prev"), F.max("adv").alias("adv"))
    return legs.join(F.broadcast(settings.select("rule", "notional")), "rule").groupBy("rule", "turn").agg(
        (F.sum(change) / 2.0).alias("turnover"),
        F.count_if(held).alias("held"),
        F.coalesce(F.avg(F.when(held & finite(impact), impact)), zero).alias("impact_adv"),
    )


def run_portfolio_grid(preds: DataFrame, rules: Mapping[str, PortfolioRules]) -> DataFrame:
    """The daily table of ``run_portfolio`` for every rule, with its name as ``rule``.

    The large prediction table should be a stored table. ``rules`` is what the caller names, a row for each; only such tables, and those with a row a day, are broadcast.
    """
    if not rules:
        raise ValueError("no rules")
    spark, rows = preds.sparkSession, usable_predictions(preds)
    plans = [schedule(rows, mode).withColumn("mode", F.lit(mode)) for mode in ("daily", "weekly")]
    days = stored(plans[0].unionByName(plans[1]), "schedule")
    one = spark.range(1).select(F.explode(F.array(*[_literal(name, r) for name, r in rules.items()])).alias("r"))
    settings = one.select(F.col("r.name").alias("rule"), "r.*").drop("name")
    targets = stored(_targets(rows, days, rules), "targets")

    columns = ["rule", "date", "turn", "weight", "y_true", "vol"]
    held = targets.where("mode = 'daily'").select(*columns)
    if any(r.rebalance == "weekly" for r in rules.values()):
        # Between rebalances what is still in the cross-section earns, at old weights.
        turns = days.where("mode = 'weekly'").select("date", "turn")
        weights = targets.where("mode = 'weekly'").select("rule", "turn", "symbol", "weight")
        held = held.unionByName(attach_daily(rows, turns, "date", "inner").join(weights, ["turn", "symbol"]).select(*columns))

    vol = F.coalesce("vol", F.lit(0.0))
    per_day = held.groupBy("rule", "date", "turn").agg(
        F.sum(F.col("weight") * F.col("y_true")).alias("gross_return"),
        F.count(F.lit(1)).alias("n_names"),
        F.sum(F.when(finite(vol), vol)).alias("vol_sum"),
        F.count_if(~finite(vol)).alias("vol_bad"),
    )
    flags = days.select(F.col("mode").alias("rebalance"), "date", "rebalances")
    traded = F.col("rebalances").cast("double")
    calm = F.coalesce(ratio(F.col("vol_sum"), (F.col("held") - F.col("vol_bad")).cast("double")), F.lit(0.0))
    slip_bps = F.col("slippage_base_bps") + F.col("slippage_k_adv") * F.col("impact_adv") * traded + F.col("slippage_k_vol") * calm
    daily = (
        per_day.join(F.broadcast(settings), "rule")
        .join(F.broadcast(flags), ["rebalance", "date"])
        .join(_trades(targets, settings), ["rule", "turn"])
        .withColumns({"slip_bps_est": slip_bps, "turnover": F.col("turnover") * traded})
        .withColumns({"commission": F.col("commission_bps") / 10000.0 * F.col("turnover"), "slippage": F.col("slip_bps_est") / 10000.0 * F.col("turnover")})
        .withColumn("cost_total", F.col("commission") + F.col("slippage"))
        .withColumn("net_return", F.col("gross_return") - F.col("cost_total"))
        .select("rule", "date", "gross_return", "net_return", "turnover", "commission", "slippage", "cost_total", "n_names", "slip_bps_est")
    )
    return with_drawdown(daily, keys=("rule",))


def grid_summary(daily: DataFrame) -> DataFrame:
    """The figures of ``portfolio_summary`` for each rule that traded."""
    return daily.groupBy("rule").agg(
        F.count(F.lit(1)).alias("days"),
        sharpe("net_return").alias("sharpe"),
        F.min("drawdown").alias("max_drawdown"),
        F.avg("turnover").alias("avg_turnover"),
        F.avg("cost_total").alias("avg_cost"),
        (F.max_by("equity", "date") - 1.0).alias("total_return"),
    )
