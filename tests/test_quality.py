import random

import pandas as pd

from panelkiln.operators import quality
from tests.helpers import PRICE_SCHEMA, frame, weekdays


def clean_rows(volume=1000.0):
    rows = []
    for symbol in ("AAA", "BBB"):
        px = 100.0
        for day in weekdays("2024-01-01", 20):
            px *= 1.001
            rows.append(
                {"symbol": symbol, "date": day, "open": px, "high": px * 1.01, "low": px * 0.99, "close": px,
                 "adj_close": px, "volume": volume}
            )
    return rows


LIMITS = {"min_obs_per_symbol": 10, "min_symbols_after_filter": 2, "volume_zero_streak_ratio_max": 0.01, "volume_zero_streak_len": 3}


def gate(spark, rows, **options):
    metrics = quality.quality_metrics(frame(spark, rows, PRICE_SCHEMA), thresholds=LIMITS, **options)
    return quality.quality_gate(metrics, thresholds=LIMITS, adjusted=options.get("adjusted", False)).first()


def test_clean_prices_pass(spark):
    row = gate(spark, clean_rows(), adjusted=True)
    assert row["passed"] and row["fail_reasons"] == []


def test_idle_streak_fails(spark):
    rows = clean_rows()
    for r in rows:
        if r["symbol"] == "AAA" and 8 <= r["date"].day <= 12 and r["date"].month == 1:
            r["volume"] = 0.0
    one = quality.idle_streaks(frame(spark, rows, PRICE_SCHEMA), 3).first()
    assert one["zero_volume_streak_violations"] == 3
    row = gate(spark, rows)
    assert not row["passed"] and row["fail_reasons"][0].startswith("zero_volume_streak")


def test_empty_and_copied_prices_fail(spark):
    assert "prices_empty" in gate(spark, [])["fail_reasons"]
    copies = clean_rows() + clean_rows()[:1]
    assert any(r.startswith("duplicates_ratio") for r in gate(spark, copies)["fail_reasons"])


def test_missing_adjusted_prices_fail(spark):
    rows = [{**r, "adj_close": None} for r in clean_rows()]
    assert "adjusted_consistency_failed" in gate(spark, rows, adjusted=True)["fail_reasons"]


def test_streaks_and_jumps_equal_a_row_scan_with_copies(spark):
    rng = random.Random(3)
    rows = []
    for symbol in [*"ABCD", None]:
        for day in weekdays("2024-01-01", 30):
            for _ in range(rng.choice([1, 1, 2, 5])):
                close = rng.choice([None, 0.0, 10.0, 11.0, 14.0])
                rows.append({"symbol": symbol, "date": day, "close": close, "volume": rng.choice([None, 0.0, 0.0, 5.0])})
    streaks = jumps = 0
    for symbol in "ABCD":
        mine = sorted(
            (r for r in rows if r["symbol"] == symbol),
            key=lambda r: (r["date"], -1.0 if r["close"] is None else r["close"], not r["volume"]),
        )
        idle = [not r["volume"] for r in mine]
        streaks += sum(all(idle[i:i + 3]) for i in range(len(idle) - 2))
        px = pd.Series([r["close"] for r in mine], dtype=float).ffill()
        jumps += int((px.pct_change().abs() > 0.2).sum())
    df = frame(spark, rows, PRICE_SCHEMA)
    assert quality.idle_streaks(df, 3).first()["zero_volume_streak_violations"] == streaks
    assert abs(quality.price_jumps(df, 0.2).first()["price_jump_ratio"] - jumps / len(rows)) < 1e-12


def test_adjustment_violations(spark):
    rows = clean_rows()
    days = sorted({r["date"] for r in rows})
    for r in rows:
        if r["symbol"] == "AAA" and r["date"] == days[5]:
            r["adj_close"] *= 1.5
    df = frame(spark, rows, PRICE_SCHEMA)
    actions = spark.createDataFrame([("aaa", days[5]), ("AAA", days[5]), ("AAA", days[9])], "symbol string, date date")
    row = quality.adjustment_violations(df, actions, actions).first()
    assert row["split_adjustment_violation_ratio"] == 0.5 and row["dividend_adjustment_violation_ratio"] == 0.5
    none = quality.adjustment_violations(df, None, None).first()
    assert tuple(none) == (0.0, 0.0)


def test_thin_symbols(spark):
    rows = clean_rows() + [{**clean_rows()[0], "symbol": "ZZZ"}]
    df = frame(spark, rows, PRICE_SCHEMA)
    assert [r["symbol"] for r in quality.thin_symbols(df, 10).collect()] == ["ZZZ"]
    assert tuple(quality.symbol_totals(df, 10).first()) == (3, 1, 2)
