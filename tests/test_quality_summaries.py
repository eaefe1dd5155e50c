import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from panelkiln.operators import quality, quality_summaries
from panelkiln.session import fresh_folder
from panelkiln.sources.tables import with_month
from tests.helpers import PRICE_SCHEMA, frame, weekdays

LIMITS = {"min_obs_per_symbol": 40, "min_symbols_after_filter": 2, "volume_zero_streak_len": 4}


def awkward_rows(seed, days=70):
    """Copies, missing and zero prices, odd bars, idle runs over month ends, rows without a day or a symbol."""
    rng = random.Random(seed)
    rows = []
    for symbol in [*"ABCDE", None]:
        idle = 0
        for day in [None, *weekdays("2024-01-15", days)]:
            if rng.random() < 0.1:
                continue
            idle = rng.choice([0, 0, 3, 40]) if idle == 0 else idle - 1
            for _ in range(rng.choice([1, 1, 2, 4])):
                close = rng.choice([None, 0.0, 10.0, 11.0, 14.0])
                rows.append(
                    {"symbol": symbol, "date": day, "open": rng.choice([-1.0, 10.0]), "high": 12.0, "low": rng.choice([9.0, None]), "close": close,
                     "adj_close": rng.choice([close, 9.0, None]), "volume": rng.choice([None, 0.0]) if idle else rng.choice([0.0, 5.0])}
                )
    rng.shuffle(rows)
    return rows


def figures(metrics):
    return {r["metric"]: r["value"] for r in metrics.collect()}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_merged_summaries_equal_the_whole_table(spark, seed):
    prices = frame(spark, awkward_rows(seed), PRICE_SCHEMA)
    want = figures(quality.quality_metrics(prices, thresholds=LIMITS))
    summaries = quality_summaries.month_summaries(prices, streak=4)
    got = figures(quality_summaries.metrics_from_summaries(summaries.orderBy(F.rand(seed)), thresholds=LIMITS))
    assert want["zero_volume_streak_violations"] > 0 and want["price_jump_ratio"] > 0 and want["duplicates_count"] > 0
    assert got == pytest.approx(want)
    profile = {r["symbol"]: r.asDict() for r in quality_summaries.merged_profile(summaries, streak=4).collect()}
    for r in quality.symbol_profile(prices, streak=4).collect():
        assert {k: profile[r["symbol"]][k] for k in r.asDict()} == r.asDict()


def test_empty_table_and_absent_columns(spark):
    empty = frame(spark, [], PRICE_SCHEMA)
    metrics = quality_summaries.metrics_from_summaries(quality_summaries.month_summaries(empty), thresholds=LIMITS)
    assert figures(metrics) == figures(quality.quality_metrics(empty, thresholds=LIMITS))
    assert "prices_empty" in quality.quality_gate(metrics).first()["fail_reasons"]
    few = frame(spark, awkward_rows(4), PRICE_SCHEMA).select("symbol", "date", "close")
    got = figures(quality_summaries.metrics_from_summaries(quality_summaries.month_summaries(few, streak=4), thresholds=LIMITS))
    assert got == pytest.approx(figures(quality.quality_metrics(few, thresholds=LIMITS)))


def test_refresh_rewrites_the_named_months_only(spark):
    rows = awkward_rows(5)
    late = [r for i, r in enumerate(rows) if r["date"] and r["date"].month == 2 and i % 3 == 0]
    last = [r for r in rows if r["date"] and r["date"] >= dt.date(2024, 4, 1)]
    early = [r for r in rows if not any(r is x for x in (*late, *last))]
    prices, store = fresh_folder(spark, "raw"), fresh_folder(spark, "quality")

    def add(part, months):
        with_month(frame(spark, part, PRICE_SCHEMA)).write.mode("append").partitionBy("month").parquet(prices)
        quality_summaries.refresh_summaries(spark, prices, store, months, streak=4)

    def files(month):
        found = quality_summaries.stored_summaries(spark, store, streak=4).where(F.col("month") == month).inputFiles()
        return {f for f in found if f"month={month}" in f}

    add(early, None)
    kept, stale = files(202403), files(202402)
    add(last, {r["date"].year * 100 + r["date"].month for r in last})
    add(late, [202402])
    assert kept and files(202403) == kept and not files(202402) & stale
    summaries = quality_summaries.stored_summaries(spark, store, streak=4)
    want = figures(quality.quality_metrics(frame(spark, rows, PRICE_SCHEMA), thresholds=LIMITS))
    assert figures(quality_summaries.metrics_from_summaries(summaries, thresholds=LIMITS)) == pytest.approx(want)
    again = figures(quality_summaries.metrics_from_summaries(summaries, thresholds=LIMITS))
    quality_summaries.refresh_summaries(spark, prices, store, [202402], streak=4)
    assert figures(quality_summaries.metrics_from_summaries(quality_summaries.stored_summaries(spark, store, streak=4), thresholds=LIMITS)) == again
