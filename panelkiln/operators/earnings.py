"""Earnings announcements as panel events."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from panelkiln.functions.columns import first_present, symbol_name
from panelkiln.functions.dates import add_business_days, day
from panelkiln.functions.numeric import number

# Vendor column aliases; the first column a table has is used.
EVENT_DATES = ("date", "earningsDate", "epsDate", "reportDate")
EPS_ACTUAL = ("eps", "epsActual", "epsReported", "epsactual")
EPS_ESTIMATE = ("epsEstimated", "epsEstimate", "epsestimated")


def earnings_events(earnings: DataFrame, *, shift_days: int) -> DataFrame:
    """(decision_date, symbol, earnings_event, eps_surprise), effective ``shift_days`` business days later."""
    when = first_present(earnings, EVENT_DATES)
    actual, estimate = first_present(earnings, EPS_ACTUAL), first_present(earnings, EPS_ESTIMATE)
    surprise = number(actual) - number(estimate) if actual and estimate else F.lit(None).cast("double")
    event_day = day(when) if when else F.lit(None).cast("date")
    return (
        earnings.select(
            event_day.alias("event_date"), symbol_name("symbol").alias("symbol"), surprise.alias("surprise")
        )
        .dropna(subset=["event_date"])
        .withColumn("decision_date", add_business_days(F.col("event_date"), shift_days))
        .groupBy("decision_date", "symbol")
        .agg(F.lit(1.0).alias("earnings_event"), F.avg("surprise").alias("eps_surprise"))
    )
