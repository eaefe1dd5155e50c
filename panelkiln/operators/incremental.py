"""Price features kept up to date without computing history again.

What a symbol's next rows need of its past is short: its last ``tail_rows`` rows,
with prices carried forward. A state is these rows for every symbol, as of the start of a month. A
refresh reads the state of the month that the first new or corrected bar
falls in, and the bars of that month and later ones; it rewrites those months of features. Bars that come
late change the day's market price and so every symbol's features after that day, which is why whole
months are computed anew, for all symbols. States of the last few months are kept; a bar from before
them makes the refresh start at an older one, or at the beginning.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from panelkiln.operators.price_features import features_of_rows, market_price, padded_rows, priced_rows, tail_rows
from panelkiln.operators.rows import attach_daily
from panelkiln.session import delete_folder, folder_names
from panelkiln.sources.store import append_new_prices, replace_months
from panelkiln.sources.tables import with_month

LOOKBACKS = (1, 5, 20, 60, 120)
KEPT_STATES = 3


def _first_day(month: int) -> date:
    return date(month // 100, month % 100, 1)


def _following(month: int) -> int:
    return month + 1 if month % 100 < 12 else month + 89


def _states(spark: SparkSession, store: str) -> list[int]:
    """Months whose state is stored whole."""
    found = [n for n in folder_names(spark, f"{store}/states") if n.isdigit()]
    return sorted(int(n) for n in found if "_SUCCESS" in folder_names(spark, f"{store}/states/{n}"))


def _tails(padded: DataFrame, month: int, rows: int) -> DataFrame:
    """Each symbol's last rows before a month."""
    latest = Window.partitionBy("symbol").orderBy(F.desc("date"))
    early = padded.where(F.col("date") < F.lit(_first_day(month)))
    return early.withColumn("_back", F.row_number().over(latest)).where(F.col("_back") <= rows).drop("_back")


def refresh_features(
    spark: SparkSession, prices: str, store: str, since: date, *, adjusted: bool = False, lookbacks: Sequence[int] = LOOKBACKS, kept_states: int = KEPT_STATES
) -> int | None:
    """Bring the features below ``store`` up to date with a month-partitioned price table that changed from ``since`` on.

    Gives the month that was read from, None for all. States that the change makes stale go first and new
    ones come last, so that a refresh which fails half-way can be run again, with the same or an earlier ``since``.
    Settings have to be the same in all refreshes of a store.
    """
    month = since.year * 100 + since.month
    known = _states(spark, store)
    base = max((m for m in known if m <= month), default=None)
    for stale in known:
        if base is None or stale > base:
            delete_folder(spark, f"{store}/states/{stale}")
    bars = spark.read.parquet(prices)
    if base is not None:
        bars = bars.where(F.col("month") >= base)
    rows = priced_rows(bars, adjusted)
    dated = attach_daily(rows, market_price(rows), "date")
    if base is not None:
        dated = dated.unionByName(spark.read.parquet(f"{store}/states/{base}"), allowMissingColumns=True)
    features = features_of_rows(dated, lookbacks=lookbacks)
    if base is not None:
        features = features.where(F.col("decision_date") >= F.lit(_first_day(base)))
    out = with_month(features, "decision_date").hint("rebalance", "month").sortWithinPartitions("month", "symbol", "decision_date")
    out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("month").parquet(f"{store}/features")
    last = bars.agg(F.max("month")).first()[0]
    boundary, boundaries = base or month, []
    while last is not None and boundary <= last:
        boundary = _following(boundary)
        boundaries.append(boundary)
    padded = padded_rows(dated)
    for boundary in boundaries[-kept_states:]:
        _tails(padded, boundary, tail_rows(lookbacks)).write.mode("overwrite").parquet(f"{store}/states/{boundary}")
    old = [m for m in _states(spark, store)][:-kept_states]
    for stale in old:
        delete_folder(spark, f"{store}/states/{stale}")
    return base


def add_bars(spark: SparkSession, new: DataFrame, prices: str, store: str, *, corrected: bool = False, order: Sequence[str] = (), **settings) -> int | None:
    """Merge bars into the stored prices and refresh the features: unknown keys only, or, ``corrected``, the new rows win."""
    since = new.agg(F.min(F.to_date("date"))).first()[0]
    if since is None:
        return None
    (replace_months if corrected else append_new_prices)(spark, prices, new, order)
    return refresh_features(spark, prices, store, since, **settings)


def stored_features(spark: SparkSession, store: str) -> DataFrame:
    return spark.read.parquet(f"{store}/features").drop("month")
