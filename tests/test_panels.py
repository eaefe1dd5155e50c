"""Panels laid out by symbol, and features that are brought up to date step by step."""

import datetime as dt
import random
import re

import pytest
from pyspark.sql import functions as F

from panelkiln import session
from panelkiln.operators import incremental
from panelkiln.operators.price_features import build_price_features
from panelkiln.session import fresh_folder
from panelkiln.sources import panels
from panelkiln.sources.store import append_new_prices

BARS = "symbol string, date date, close double, high double, low double, volume double"
START = dt.date(2023, 1, 2)


def random_bars(seed, symbols=4, days=320):
    rng, rows = random.Random(seed), []
    for s in range(symbols):
        price = 100.0
        for d in range(days):
            price *= 1 + rng.gauss(0, 0.02)
            if rng.random() < 0.8:
                close = None if rng.random() < 0.05 else price
                rows.append((f"S{s}", START + dt.timedelta(days=d), close, price * 1.01, price * 0.99, rng.choice([None, 0.0, 10.0, 25.0])))
    return rows


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges_by_symbol(df):
    return re.findall(r"Exchange hashpartitioning\([^)]*symbol", plan_of(df))


def by_key(df):
    return {(r.decision_date, r.symbol): r.asDict() for r in df.collect()}


def assert_same(got, want):
    got, want = by_key(got), by_key(want)
    assert got.keys() == want.keys()
    for key, row in want.items():
        for c, v in row.items():
            assert got[key][c] == (pytest.approx(v, rel=1e-9, abs=1e-12) if isinstance(v, float) else v), (key, c)


@pytest.fixture
def laid_out(spark):
    rows = random_bars(1)
    bars = spark.createDataFrame(rows, BARS)
    events = bars.where("volume = 10").select(F.col("date").alias("decision_date"), "symbol", F.lit(1.0).alias("event"), F.col("close").alias("size"))
    paths = [fresh_folder(spark, "t-panel") for _ in range(2)]
    panels.write_panel(bars, paths[0], buckets=4)
    panels.write_panel(events, paths[1], buckets=4, sort_by=["decision_date"])
    return bars, events, paths


def test_features_labels_and_events_need_no_exchange_by_symbol(spark, laid_out):
    bars, events, paths = laid_out
    own, own_events = (panels.attach_panel(spark, p) for p in paths)
    features = build_price_features(own, lookbacks=(1, 5), label_horizon=3)
    joined = panels.with_daily_events(features, own_events)
    plain = build_price_features(bars, lookbacks=(1, 5), label_horizon=3).join(events, ["decision_date", "symbol"], "left")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert exchanges_by_symbol(joined) == [] and exchanges_by_symbol(plain)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert_same(joined, plain)


def test_a_bucket_is_one_file_and_appends_keep_the_layout(spark, laid_out):
    bars, _, (path, _) = laid_out
    table = panels.attach_panel(spark, path, "t_appended")
    assert len(table.inputFiles()) <= 4 and sorted(map(tuple, table.collect()), key=repr) == sorted(map(tuple, bars.collect()), key=repr)
    more = spark.createDataFrame([("S0", dt.date(2024, 6, 3), 5.0, 5.0, 5.0, 1.0), ("T", None, None, None, None, None)], BARS)
    panels.append_panel(more, path, "t_appended")
    again = panels.attach_panel(spark, path)
    assert again.count() == bars.count() + 2
    assert exchanges_by_symbol(again.groupBy("symbol").count()) == [] and exchanges_by_symbol(bars.groupBy("symbol").count())


def test_events_without_rows_and_repeated_events(spark, laid_out):
    bars, events, _ = laid_out
    panel = bars.select(F.col("date").alias("decision_date"), "symbol", "close")
    assert_same(panels.with_daily_events(panel, events.limit(0)), panel.withColumns({"event": F.lit(None).cast("double"), "size": F.lit(None).cast("double")}))
    twice = events.union(events.withColumn("event", F.lit(0.5))).union(events.limit(1).withColumn("decision_date", F.lit(None).cast("date")))
    got = panels.with_daily_events(panel, twice)
    assert_same(got, panel.join(events.withColumn("event", F.lit(0.5)), ["decision_date", "symbol"], "left"))


def test_daily_refreshes_equal_the_full_build(spark):
    """In order, late by days, late by more than the kept states reach, corrected, and a symbol that starts late."""
    rows = random_bars(2)
    late = [r for r in rows if r[0] == "S1" and r[1] in {START + dt.timedelta(days=k) for k in (40, 41, 200)}]
    new = [r for r in rows if r[0] == "S3" and r[1] < START + dt.timedelta(days=250)]
    first = [r for r in rows if r not in late and r not in new and r[1] < START + dt.timedelta(days=290)]
    rest = [r for r in rows if r not in late and r not in new and r not in first]
    days = sorted({r[1] for r in rest})
    lots = [first, [r for r in rest if r[1] <= days[2]], [r for r in rest if days[2] < r[1] <= days[-2]], late[2:], late[:2], [r for r in rest if r[1] > days[-2]]]
    prices, store = fresh_folder(spark, "t-prices"), fresh_folder(spark, "t-features")
    settings = {"lookbacks": (1, 5, 20)}
    held = []
    for lot in lots:
        incremental.add_bars(spark, spark.createDataFrame(lot, BARS), prices, store, **settings)
        held += lot
        want = build_price_features(spark.createDataFrame(held, BARS), **settings)
        assert_same(incremental.stored_features(spark, store), want)
    corrected = [(*r[:2], 50.0, *r[3:]) for r in held if r[1] in (START + dt.timedelta(days=150), START + dt.timedelta(days=300))]
    incremental.add_bars(spark, spark.createDataFrame(corrected, BARS), prices, store, corrected=True, **settings)
    keys = {r[:2] for r in corrected}
    held = [r for r in held if r[:2] not in keys] + corrected
    assert_same(incremental.stored_features(spark, store), build_price_features(spark.createDataFrame(held, BARS), **settings))
    assert incremental.add_bars(spark, spark.createDataFrame([], BARS), prices, store, **settings) is None


def test_a_refresh_reads_a_state_and_the_months_since(spark):
    rows = random_bars(3, symbols=2)
    last = max(r[1] for r in rows)
    prices, store = fresh_folder(spark, "t-prices"), fresh_folder(spark, "t-features")
    append_new_prices(spark, prices, spark.createDataFrame([r for r in rows if r[1] < last], BARS))
    assert incremental.refresh_features(spark, prices, store, START, lookbacks=(1,)) is None
    assert len(session.folder_names(spark, f"{store}/states")) == incremental.KEPT_STATES
    state = spark.read.parquet(f"{store}/states/{incremental._states(spark, store)[0]}")
    assert state.groupBy("symbol").count().agg(F.max("count")).first()[0] == 22
    base = incremental.add_bars(spark, spark.createDataFrame([r for r in rows if r[1] == last], BARS), prices, store, lookbacks=(1,))
    assert base == last.year * 100 + last.month
    # A refresh that broke off after it had dropped stale states is run again from an earlier one.
    session.delete_folder(spark, f"{store}/states/{base}")
    again = incremental.refresh_features(spark, prices, store, last, lookbacks=(1,))
    assert again is not None and again < base
    assert_same(incremental.stored_features(spark, store), build_price_features(spark.createDataFrame(rows, BARS), lookbacks=(1,)))
