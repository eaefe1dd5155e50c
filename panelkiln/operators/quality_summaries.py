"""Price quality from stored summaries, so that the gate reads the months that changed and no others.

A summary is one row per symbol and month. Counts of rows add up over months, as
do distinct days, since a day lies in one month. What crosses a month's end is kept open: the first
and last close, and the idle rows before the first and after the last active one. Merging
compares a month's first close with the last one before it, and joins the open idle
rows of neighbouring months into runs, however many months a run takes. Rows without a date are a month
of their own, before all others, as they come first in the order of a symbol's quotes.

The figures equal those of ``quality.quality_metrics`` without the adjusted ones, which look at the days of
actions and take ``quality.adjustment_violations``.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from panelkiln.functions.numeric import growth, number, ratio, truthy
from panelkiln.operators import quality
from panelkiln.sources.tables import with_month

#: Columns of a summary that merging adds up.
_SUMS = ("rows", "obs", "days", "odd", "zero", "jumps")


def _moved(now: Column, before: Column, jump: float) -> Column:
    from_zero = truthy((before == 0) & (now != 0))
    return from_zero | truthy(F.abs(growth(now, before)) > jump)


def _stretches(idle: Column, streak: int) -> Column:
    return F.greatest(idle - F.lit(streak - 1), F.lit(0))


def _counted_quotes(prices: DataFrame) -> DataFrame:
    """Distinct quotes with the rows behind each, and what single rows tell: one pass, combined before the shuffle."""
    names = [c for c in quality.PRICE_COLUMNS if c in prices.columns]
    volume = number("volume") if "volume" in names else F.lit(1.0)
    flags = {
        "idle": F.coalesce(volume, F.lit(0.0)) <= 0,
        "odd": quality.odd_bar(prices),
        "zero": truthy(volume == 0),
        **{f"missing_{c}": number(c).isNull() for c in names},
    }
    adjusted = number("adj_close") if "adj_close" in names else F.lit(None).cast("double")
    rows = prices.select(
        "symbol", F.to_date("date").alias("date"), number("close").alias("close"), adjusted.alias("adj_close"), *[f.alias(n) for n, f in flags.items()]
    )
    counts = [F.count(F.lit(1)).alias("rows"), *[F.count_if(n).alias(n) for n in flags]]
    return with_month(rows.groupBy("symbol", "date", "close", "adj_close").agg(*counts))


def month_summaries(prices: DataFrame, *, streak: int = 5, jump: float = 0.2) -> DataFrame:
    """One row per (symbol, month) of raw prices, copies and all.

    Rows without a symbol have counts only: they are in no order, so they have no closes, jumps or idle runs.
    An empty table gives an empty one.
    """
    rows = _counted_quotes(prices)
    missing = [c for c in rows.columns if c.startswith("missing_")]
    dated = F.when(F.col("date").isNotNull(), F.col("rows")).otherwise(0)
    plain = [F.sum(c).alias(c) for c in ("rows", "odd", "zero", *missing)] + [F.sum(dated).alias("obs")]

    w = Window.partitionBy("symbol", "month").orderBy("date", "close", "adj_close")
    padded = rows.where("symbol is not null").withColumn("padded", F.last("close", ignorenulls=True).over(w))
    walked = padded.withColumns(
        {
            "run": F.count_if(F.col("rows") > F.col("idle")).over(w),
            "jumped": _moved(F.col("padded"), F.lag("padded").over(w), jump),
            "new_day": F.row_number().over(w).eqNullSafe(1) | ~F.col("date").eqNullSafe(F.lag("date").over(w)),
        }
    )
    quote = F.when(F.col("close").isNotNull(), F.struct("date", "close", "adj_close"))
    runs = walked.groupBy("symbol", "month", "run").agg(
        *plain, F.count_if("new_day").alias("days"), F.count_if("jumped").alias("jumps"), F.sum("idle").alias("idle"),
        F.min(quote).alias("first"), F.max(quote).alias("last"),
    )
    active = F.max("run") > 0
    suffix = F.when(active, F.max_by("idle", "run")).otherwise(F.lit(0))
    closed = F.sum(F.when(F.col("run") > 0, _stretches(F.col("idle"), streak)).otherwise(0))
    named = runs.groupBy("symbol", "month").agg(
        *[F.sum(c).alias(c) for c in (*_SUMS, *missing)],
        F.min("first").getField("close").alias("first_close"),
        F.max("last").getField("close").alias("last_close"),
        F.sum(F.when(F.col("run") == 0, F.col("idle")).otherwise(0)).alias("prefix"),
        suffix.alias("suffix"),
        (closed - _stretches(suffix, streak)).alias("closed"),
        active.alias("active"),
    )
    days = rows.where("symbol is null").groupBy("symbol", "month", "date").agg(*plain)
    nameless = days.groupBy("symbol", "month").agg(*[F.sum(c).alias(c) for c in ("rows", "obs", "odd", "zero", *missing)], F.count(F.lit(1)).alias("days"))
    return named.unionByName(nameless, allowMissingColumns=True)


def _place(store: str, streak: int, jump: float) -> str:
    return f"{store}/summaries-{streak}-{jump}"


def refresh_summaries(
    spark: SparkSession, prices: str, store: str, months: Iterable[int] | None = None, *, streak: int = 5, jump: float = 0.2
) -> None:
    """Summarise a month-partitioned price table again in ``months`` (yyyymm; None: all) and replace those summaries.

    Months not named are neither read nor written; rows without a date are always counted anew. Running it again changes nothing. A month keeps its
    summaries when all of its rows are taken out of the table.
    Other settings are another table of summaries.
    """
    rows = spark.read.parquet(prices)
    if months is not None:
        rows = rows.where(F.col("month").isNull() | F.col("month").isin([int(m) for m in months]))
    out = month_summaries(rows, streak=streak, jump=jump).hint("rebalance", "month").sortWithinPartitions("month", "symbol")
    out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("month").parquet(_place(store, streak, jump))


def stored_summaries(spark: SparkSession, store: str, *, streak: int = 5, jump: float = 0.2) -> DataFrame:
    return spark.read.parquet(_place(store, streak, jump))


def merged_profile(summaries: DataFrame, *, streak: int = 5, jump: float = 0.2) -> DataFrame:
    """Per symbol what ``quality.symbol_profile`` gives, and the sums over single rows, from summaries in any order.

    One exchange by symbol, of a row for each of its months.
    """
    missing = [c for c in summaries.columns if c.startswith("missing_")]
    sums = [*_SUMS, *missing]
    w = Window.partitionBy("symbol").orderBy(F.col("month").asc_nulls_first())
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    named = summaries.where("symbol is not null").withColumns(
        {"carried": F.last("last_close", ignorenulls=True).over(before), "since": F.count_if("active").over(before)}
    )
    crossed = _moved(F.col("first_close"), F.col("carried"), jump).cast("long")
    # Idle rows that no active row parts have the number of active months before them in common.
    since = F.coalesce("since", F.lit(0))
    ends = F.array(
        F.struct(since.alias("run"), F.col("prefix").alias("idle")),
        F.struct((since + F.col("active").cast("long")).alias("run"), F.col("suffix").alias("idle")),
    )
    parts = named.withColumn("jumps", F.col("jumps") + crossed).select("symbol", *sums, "closed", F.posexplode(ends).alias("at", "end"))
    once = [F.sum(F.when(F.col("at") == 0, F.col(c)).otherwise(0)).alias(c) for c in (*sums, "closed")]
    runs = parts.groupBy("symbol", "end.run").agg(*once, F.sum("end.idle").alias("idle"))
    idle = F.sum(F.col("closed") + _stretches(F.col("idle"), streak)).alias("idle_stretches")
    profile = runs.groupBy("symbol").agg(*[F.sum(c).alias(c) for c in sums], idle)
    nameless = summaries.where("symbol is null").groupBy("symbol").agg(*[F.sum(F.coalesce(c, F.lit(0))).alias(c) for c in sums])
    return profile.unionByName(nameless.withColumn("idle_stretches", F.lit(0).cast("long")))


def metrics_from_summaries(summaries: DataFrame, *, thresholds: Mapping[str, float] | None = None) -> DataFrame:
    """All figures of single rows and symbols as (metric, value) rows, for ``quality.quality_gate``.

    ``volume_zero_streak_len`` and ``price_jump_threshold`` have to be those the summaries were made with.
    """
    t = {**quality.DEFAULTS, **(thresholds or {})}
    streak = int(t["volume_zero_streak_len"])
    missing = [c for c in summaries.columns if c.startswith("missing_")]
    shares = {c: ratio(F.sum(c), F.sum("rows")) for c in missing}
    has_volume = "missing_volume" in missing
    figures = [
        F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
        *[share.alias(c) for c, share in shares.items()],
        (sum(shares.values(), F.lit(0.0)) / F.lit(float(max(1, len(missing))))).alias("missing_ratio_overall"),
        F.coalesce(F.sum("odd"), F.lit(0)).alias("ohlc_anomaly_rows"),
        ratio(F.sum("odd"), F.sum("rows")).alias("ohlc_anomaly_ratio"),
        (ratio(F.sum("zero"), F.sum("rows")) if has_volume else F.lit(None).cast("double")).alias("volume_zero_ratio"),
        *quality.profile_figures(int(t["min_obs_per_symbol"]), streaks=streak > 1 and has_volume),
    ]
    profile = merged_profile(summaries, streak=streak, jump=t["price_jump_threshold"])
    return quality.as_metrics(profile.agg(*figures))
