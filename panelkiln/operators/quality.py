"""Price quality: missing values, copies, odd bars, idle volume, jumps, adjustment consistency, and the gate.

Raw prices may hold copies, so nothing here assumes unique keys. Rows are first
collapsed to ``quotes``: one row per distinct (symbol, date, close, adj_close)
with counts. Copies of a quote add no return and extend no run in a way the
counts cannot tell, so the per-symbol windows see distinct quotes only.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window, functions as F

from panelkiln.functions.columns import symbol_name
from panelkiln.functions.numeric import growth, number, truthy

PRICE_COLUMNS = ("open", "high", "low", "close", "adj_close", "volume")

# Default thresholds of the gate.
DEFAULTS = {
    "missing_ratio_max": 0.05,
    "anomaly_row_ratio_max": 0.02,
    "duplicates_ratio_max": 0.0,
    "min_obs_per_symbol": 252,
    "min_symbols_after_filter": 20,
    "adjclose_missing_ratio_max": 0.02,
    "price_jump_threshold": 0.2,
    "volume_zero_streak_len": 5,
    "volume_zero_streak_ratio_max": 0.02,
    "split_adjustment_violation_ratio_max": 0.3,
    "dividend_adjustment_violation_ratio_max": 0.3,
    "split_adj_multiplier_max": 1.2,
    "div_adj_extra_tolerance": 0.03,
}


def _present(prices: DataFrame) -> list[str]:
    return [c for c in PRICE_COLUMNS if c in prices.columns]


def _is_missing(name: str) -> Column:
    return number(name).isNull()


def missing_ratios(prices: DataFrame) -> DataFrame:
    """One row: the missing share of each price column and the mean of those shares."""
    return prices.agg(*_missing_figures(prices))


def _missing_figures(prices: DataFrame) -> list[Column]:
    names = _present(prices)
    shares = {c: F.avg(_is_missing(c).cast("double")) for c in names}
    overall = sum(shares.values(), F.lit(0.0)) / F.lit(float(max(1, len(names))))
    return [*[share.alias(f"missing_{c}") for c, share in shares.items()], overall.alias("missing_ratio_overall")]


def duplicates(prices: DataFrame) -> DataFrame:
    """One row: rows beyond the first of each (date, symbol), and their share."""
    return symbol_profile(prices).agg(*_duplicate_figures())


def _duplicate_figures() -> list[Column]:
    rows = F.coalesce(F.sum("rows"), F.lit(0))
    extra = rows - F.coalesce(F.sum("days"), F.lit(0))
    return [extra.alias("duplicates_count"), (extra / F.greatest(rows, F.lit(1))).alias("duplicates_ratio")]


def odd_bar(prices: DataFrame) -> Column:
    """True when a bar has a negative price, high below low, or close outside [low, high]."""
    names = ("open", "high", "low", "close")
    if not set(names) <= set(prices.columns):
        return F.lit(False)
    o, h, low, c = (number(n) for n in names)
    negative = truthy(o < 0) | truthy(h < 0) | truthy(low < 0) | truthy(c < 0)
    return negative | truthy(h < low) | truthy(c < low) | truthy(c > h)


def bar_anomalies(prices: DataFrame) -> DataFrame:
    """One row: count and share of odd bars, and the share of rows with zero volume."""
    return prices.agg(*_anomaly_figures(prices))


def _anomaly_figures(prices: DataFrame) -> list[Column]:
    odd = odd_bar(prices).cast("long")
    idle = truthy(number("volume") == 0).cast("double") if "volume" in prices.columns else F.lit(None).cast("double")
    return [
        F.coalesce(F.sum(odd), F.lit(0)).alias("ohlc_anomaly_rows"),
        F.avg(odd.cast("double")).alias("ohlc_anomaly_ratio"),
        F.avg(idle).alias("volume_zero_ratio"),
    ]


def quotes(prices: DataFrame) -> DataFrame:
    """Distinct quotes with the number of rows behind each, split by idle and active volume."""
    volume = number("volume") if "volume" in prices.columns else F.lit(1.0)
    adjusted = number("adj_close") if "adj_close" in prices.columns else F.lit(None).cast("double")
    idle = F.coalesce(volume, F.lit(0.0)) <= 0
    return (
        prices.select(
            "symbol", F.to_date("date").alias("date"), number("close").alias("close"), adjusted.alias("adj_close"),
            idle.alias("idle"),
        )
        .groupBy("symbol", "date", "close", "adj_close")
        .agg(F.count(F.lit(1)).alias("n"), F.count_if("idle").alias("n_idle"))
    )


def _quote_order():
    return Window.partitionBy("symbol").orderBy("date", "close", "adj_close")


def symbol_profile(prices: DataFrame, *, streak: int = 5, jump: float = 0.2) -> DataFrame:
    """Per symbol: rows, dated rows, distinct days, idle stretches of ``streak`` rows, jumps above ``jump``.

    A run of L idle rows holds L - streak + 1 idle stretches, and a quote with an
    active row starts a new run with its idle rows. After the quotes are formed,
    everything happens inside one partitioning by symbol. Rows without a symbol are one
    group of counts (symbol NULL): they have no order to run in, so no idle
    stretches and no jumps, and pass no window.
    """
    w = _quote_order()
    new_day = F.row_number().over(w).eqNullSafe(1) | ~F.col("date").eqNullSafe(F.lag("date").over(w))
    jumped = truthy(F.col("close_move") > jump).cast("long")
    named = quote_returns(prices.filter(F.col("symbol").isNotNull()))
    nameless = quotes(prices.filter(F.col("symbol").isNull())).groupBy("date").agg(F.sum("n").alias("n"))
    nameless = nameless.agg(
        F.sum("n").alias("rows"),
        F.sum(F.when(F.col("date").isNotNull(), F.col("n")).otherwise(0)).alias("obs"),
        F.count(F.lit(1)).alias("days"),
    ).filter("rows > 0")
    runs = (
        named.withColumns({"run": F.count_if(F.col("n") > F.col("n_idle")).over(w), "new_day": new_day})
        .groupBy("symbol", "run")
        .agg(
            F.sum("n").alias("rows"),
            F.sum(F.when(F.col("date").isNotNull(), F.col("n")).otherwise(0)).alias("obs"),
            F.count_if("new_day").alias("days"),
            F.sum("n_idle").alias("idle"),
            F.sum(jumped).alias("jumps"),
        )
    )
    stretches = F.greatest(F.col("idle") - F.lit(streak - 1), F.lit(0))
    sums = [F.sum(c).alias(c) for c in ("rows", "obs", "days", "jumps")]
    per_symbol = runs.groupBy("symbol").agg(*sums, F.sum(stretches).alias("idle_stretches"))
    none = [F.lit(0).cast("long").alias(c) for c in ("jumps", "idle_stretches")]
    without = nameless.select(F.lit(None).cast(prices.schema["symbol"].dataType).alias("symbol"), "rows", "obs", "days", *none)
    return per_symbol.unionByName(without)


def idle_streaks(prices: DataFrame, length: int) -> DataFrame:
    """One row: number of ``length``-row stretches without volume, and their share of all rows."""
    return symbol_profile(prices, streak=length).agg(*_streak_figures())


def _streak_figures() -> list[Column]:
    found = F.coalesce(F.sum("idle_stretches"), F.lit(0))
    share = found / F.greatest(F.coalesce(F.sum("rows"), F.lit(0)), F.lit(1))
    return [
        found.alias("zero_volume_streak_violations"), share.alias("zero_volume_streak_violation_ratio")
    ]


def quote_returns(prices: DataFrame) -> DataFrame:
    """Quotes with the size of their raw and adjusted one-row move, missing prices padded."""
    w = _quote_order()
    through = w.rowsBetween(Window.unboundedPreceding, 0)
    padded = quotes(prices).withColumns(
        {f"_{c}": F.last(c, ignorenulls=True).over(through) for c in ("close", "adj_close")}
    )

    def move(name: str) -> Column:
        previous = F.lag(name).over(w)
        jump_from_zero = (previous == 0) & (F.col(name) != 0)
        return F.when(jump_from_zero, F.lit(float("inf"))).otherwise(F.abs(growth(F.col(name), previous)))

    return padded.withColumns({"close_move": move("_close"), "adj_move": move("_adj_close")})


def price_jumps(prices: DataFrame, threshold: float) -> DataFrame:
    """One row: share of rows whose close moved by more than ``threshold``; first rows count as calm."""
    return symbol_profile(prices, jump=threshold).agg(*_jump_figures())


def _jump_figures() -> list[Column]:
    return [F.try_divide(F.sum("jumps"), F.sum("rows")).alias("price_jump_ratio")]


def thin_symbols(prices: DataFrame, min_obs: int) -> DataFrame:
    """Symbols with fewer than ``min_obs`` dated rows."""
    return prices.groupBy("symbol").agg(F.count("date").alias("obs")).filter(F.col("obs") < min_obs)


def symbol_totals(prices: DataFrame, min_obs: int) -> DataFrame:
    """One row: symbols in all, too thin, and left."""
    return prices.groupBy("symbol").agg(F.count("date").alias("obs")).agg(*_total_figures(min_obs))


def _total_figures(min_obs: int) -> list[Column]:
    known = F.col("symbol").isNotNull()
    thin = F.count_if(known & (F.col("obs") < min_obs))
    return [
        F.count_if(known).alias("symbols_total"),
        thin.alias("symbols_excluded_min_obs"),
        (F.count_if(known) - thin).alias("symbols_after_filter"),
    ]


def action_days(actions: DataFrame) -> DataFrame:
    return actions.select(symbol_name("symbol").alias("symbol"), F.to_date("date").alias("date")).distinct()


def adjustment_violations(
    prices: DataFrame,
    splits: DataFrame | None,
    dividends: DataFrame | None,
    *,
    split_multiplier: float = DEFAULTS["split_adj_multiplier_max"],
    dividend_tolerance: float = DEFAULTS["div_adj_extra_tolerance"],
) -> DataFrame:
    """One row: share of split and dividend days on which the adjusted price moved too far."""
    flags = None
    for name, table in (("is_split", splits), ("is_dividend", dividends)):
        if table is not None:
            days = action_days(table).withColumn(name, F.lit(True))
            flags = days if flags is None else flags.unionByName(days, allowMissingColumns=True)
    moves = quote_returns(prices.filter(F.col("symbol").isNotNull()))
    if flags is None:
        return moves.agg(
            F.lit(0.0).alias("split_adjustment_violation_ratio"),
            F.lit(0.0).alias("dividend_adjustment_violation_ratio"),
        )
    flags = flags.withColumns(
        {c: F.col(c) if c in flags.columns else F.lit(None).cast("boolean") for c in ("is_split", "is_dividend")}
    )
    per_day = flags.groupBy("symbol", "date").agg(
        F.coalesce(F.bool_or("is_split"), F.lit(False)).alias("is_split"),
        F.coalesce(F.bool_or("is_dividend"), F.lit(False)).alias("is_dividend"),
    )
    split_limit = F.col("close_move") * F.lit(split_multiplier) + F.lit(1e-8)
    dividend_limit = F.col("close_move") + F.lit(dividend_tolerance)

    def share(flag: str, limit: Column) -> Column:
        bad = F.count_if(F.col(flag) & truthy(F.col("adj_move") > limit))
        matched = F.sum(F.when(F.col(flag), F.col("n")))
        return F.coalesce(F.try_divide(bad, matched), F.lit(0.0))

    return moves.join(per_day, ["symbol", "date"], "inner").agg(
        share("is_split", split_limit).alias("split_adjustment_violation_ratio"),
        share("is_dividend", dividend_limit).alias("dividend_adjustment_violation_ratio"),
    )


def profile_figures(min_obs: int, *, streaks: bool) -> list[Column]:
    """Aggregates over symbol profiles: copies, jumps, symbols left, and, if wanted, idle stretches."""
    figures = [*_duplicate_figures(), *_jump_figures(), *_total_figures(min_obs)]
    return figures + _streak_figures() if streaks else figures


def as_metrics(one_row: DataFrame) -> DataFrame:
    """A one-row table as (metric, value) rows."""
    pairs = F.explode(
        F.array(
            *[
                F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value"))
                for c in one_row.columns
            ]
        )
    )
    return one_row.select(pairs.alias("p")).select("p.*")


def quality_metrics(
    prices: DataFrame,
    *,
    thresholds: Mapping[str, float] | None = None,
    adjusted: bool = False,
    splits: DataFrame | None = None,
    dividends: DataFrame | None = None,
) -> DataFrame:
    """All quality figures as (metric, value) rows."""
    t = {**DEFAULTS, **(thresholds or {})}
    streak = int(t["volume_zero_streak_len"])
    profile = symbol_profile(prices, streak=streak, jump=t["price_jump_threshold"])
    figures = profile_figures(int(t["min_obs_per_symbol"]), streaks=streak > 1 and "volume" in prices.columns)
    # Two passes over the prices: one for figures of single rows, one for those of symbols.
    parts = [
        prices.agg(F.count(F.lit(1)).alias("rows"), *_missing_figures(prices), *_anomaly_figures(prices)),
        profile.agg(*figures),
    ]
    if adjusted and "adj_close" in prices.columns:
        parts.append(
            adjustment_violations(
                prices,
                splits,
                dividends,
                split_multiplier=t["split_adj_multiplier_max"],
                dividend_tolerance=t["div_adj_extra_tolerance"],
            )
        )
    metrics = as_metrics(parts[0])
    for part in parts[1:]:
        metrics = metrics.unionByName(as_metrics(part))
    return metrics


def quality_gate(
    metrics: DataFrame, *, thresholds: Mapping[str, float] | None = None, adjusted: bool = False
) -> DataFrame:
    """One row: ``passed`` and ``fail_reasons``; an empty price table fails."""
    t = {**DEFAULTS, **(thresholds or {})}

    def value(name: str) -> Column:
        return F.max(F.when(F.col("metric") == name, F.col("value")))

    limits = (
        ("missing_ratio_overall", t["missing_ratio_max"]),
        ("ohlc_anomaly_ratio", t["anomaly_row_ratio_max"]),
        ("duplicates_ratio", t["duplicates_ratio_max"]),
        ("zero_volume_streak_violation_ratio", t["volume_zero_streak_ratio_max"]),
    )
    names = [n for n, _ in limits] + [
        "rows", "symbols_after_filter", "missing_adj_close",
        "split_adjustment_violation_ratio", "dividend_adjustment_violation_ratio",
    ]
    row = metrics.agg(*[value(n).alias(n) for n in names])
    least = int(t["min_symbols_after_filter"])
    reasons = [F.when(F.coalesce(F.col("rows"), F.lit(0.0)) == 0, F.lit("prices_empty"))]
    reasons += [
        F.when(F.col(n) > limit, F.format_string(f"{n}=%.6f>{limit}", F.col(n))) for n, limit in limits
    ]
    reasons.append(
        F.when(
            F.col("symbols_after_filter") < least,
            F.format_string(f"symbols_after_filter=%d<{least}", F.col("symbols_after_filter").cast("long")),
        )
    )
    if adjusted:
        consistent = (
            truthy(F.col("missing_adj_close") <= t["adjclose_missing_ratio_max"])
            & truthy(F.col("split_adjustment_violation_ratio") <= t["split_adjustment_violation_ratio_max"])
            & truthy(F.col("dividend_adjustment_violation_ratio") <= t["dividend_adjustment_violation_ratio_max"])
        )
        reasons.append(F.when(~consistent, F.lit("adjusted_consistency_failed")))
    fail_reasons = F.filter(F.array(*reasons), lambda r: r.isNotNull())
    return row.select((F.size(fail_reasons) == 0).alias("passed"), fail_reasons.alias("fail_reasons"))
