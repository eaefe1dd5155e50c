import datetime as dt

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from panelkiln.operators import feature_store, news
from panelkiln.operators.earnings import earnings_events
from tests.helpers import PRICE_SCHEMA, frame, random_prices, table

D = dt.date


def by_symbol(df, **options):
    rows = news.news_by_symbol(news.story_groups(df, shift_days=1, **options)).collect()
    return {(r["symbol"], r["decision_date"]): r for r in rows}


def test_ticker_list_reaches_each_symbol(spark):
    df = spark.createDataFrame(
        [("2024-03-01", "XETRA:KLM | OTC:PQR-A", "strong growth", None, "x")],
        "date string, tickers string, title string, content string, site string",
    )
    got = by_symbol(df)
    # Friday news acts on Monday.
    assert set(got) == {("KLM", D(2024, 3, 4)), ("PQR-A", D(2024, 3, 4))}
    assert got["KLM", D(2024, 3, 4)]["news_sent_mean_1d"] == 1.0


def test_market_news_without_symbols(spark):
    df = spark.createDataFrame([("2024-03-04", "rates rise", "x")], "date string, title string, site string")
    assert set(by_symbol(df)) == {("GENERAL", D(2024, 3, 5))}


def test_general_symbol_gives_way_to_tickers_only_when_asked(spark):
    df = spark.createDataFrame(
        [("2024-03-04", "GENERAL", "AAA,MARKET", "t", "x")],
        "date string, symbol string, tickers string, title string, site string",
    )
    assert {k[0] for k in by_symbol(df)} == {"GENERAL"}
    assert {k[0] for k in by_symbol(df, use_tickers_for_general=True)} == {"AAA"}


def test_dates_coalesce_per_row_and_undated_rows_drop(spark):
    df = spark.createDataFrame(
        [("2024-03-04 10:00:00", None, "A"), (None, "2024-03-05", "B"), ("bad", "bad", "C")],
        "publishedDate string, date string, tickers string",
    ).withColumn("title", F.lit("t"))
    assert set(by_symbol(df)) == {("A", D(2024, 3, 5)), ("B", D(2024, 3, 6))}


def test_counts_sources_and_vendor_scores(spark):
    df = spark.createDataFrame(
        [
            ("2024-03-04", "A", "s1", "0.5"), ("2024-03-04", "A", "s1", "9"), ("2024-03-04", "A", "s2", None),
            ("2024-03-04", "A,B", None, "-0.5"),
        ],
        "date string, symbol string, site string, sentiment string",
    )
    groups = news.story_groups(df, shift_days=1)
    a = {r["symbol"]: r for r in news.news_by_symbol(groups).collect()}
    assert (a["A"]["news_count_1d"], a["A"]["news_source_nuniq_1d"]) == (4, 3)
    assert abs(a["A"]["news_sent_mean_1d"] - (0.5 + 1.0 - 0.5) / 3) < 1e-12
    market = news.news_by_market(groups).first()
    assert market["mkt_news_count_1d"] == 4


def test_rolling_news_equals_pandas(spark):
    rng = np.random.default_rng(0)
    rows = [
        (s, D(2024, 1, 1) + dt.timedelta(days=i), float(rng.integers(0, 3)), float(rng.normal()), float(rng.integers(3, 9)),
         float(rng.normal()))
        for s in ("A", "B") for i in range(30)
    ]
    schema = (
        "symbol string, decision_date date, news_count_1d double, news_sent_mean_1d double, mkt_news_count_1d double,"
        " mkt_news_sent_mean_1d double"
    )
    got = table(feature_store.rolling_news(spark.createDataFrame(rows[::-1], schema)), "symbol", "decision_date")
    df = pd.DataFrame(rows, columns=[c.split()[0] for c in schema.split(",")])

    def roll(column, n, m, how):
        return getattr(df.groupby("symbol")[column].rolling(n, min_periods=m), how)().to_numpy()

    want = {
        "news_count_5d": roll("news_count_1d", 5, 1, "sum"),
        "news_count_20d": roll("news_count_1d", 20, 1, "sum"),
        "news_sent_mean_5d": roll("news_sent_mean_1d", 5, 1, "mean"),
        "news_sent_std_20d": np.nan_to_num(roll("news_sent_mean_1d", 20, 2, "std")),
        "mkt_news_count_20d": roll("mkt_news_count_1d", 20, 1, "sum"),
        "mkt_news_sent_mean_5d": roll("mkt_news_sent_mean_1d", 5, 1, "mean"),
    }
    for name, values in want.items():
        np.testing.assert_allclose(got[name], values, atol=1e-9, err_msg=name)


def test_store_fills_quiet_days_with_zero(spark):
    rows = random_prices(seed=1, symbols=2, nulls=0)
    prices = frame(spark, rows, PRICE_SCHEMA)
    members = prices.select("date", "symbol", F.lit(True).alias("is_member")).filter("symbol = 'S0'")
    articles = spark.createDataFrame(
        [("2024-02-01", "GENERAL", "strong")], "date string, symbol string, title string"
    )
    built = feature_store.build_feature_store(prices=prices, membership=members, news=articles, lookbacks=(1,))
    got = table(built, "decision_date")
    assert set(got["symbol"]) == {"S0"}
    assert (got["news_count_1d"] == 0).all() and (got["eps_surprise"] == 0).all()
    day = got[got["decision_date"] == D(2024, 2, 2)]
    assert day.empty or day["mkt_news_count_1d"].iloc[0] == 1
    no_news = feature_store.build_feature_store(prices=prices, membership=members, lookbacks=(1,))
    assert not any(c.startswith(("news", "mkt")) for c in no_news.columns)


def test_earnings_events(spark):
    df = spark.createDataFrame(
        [("2024-03-01", "aaa", "2.0", "1.5"), ("2024-03-02", "AAA", "x", "1.0"), ("bad", "AAA", "1", "1"), ("2024-03-03", "BBB", "1", "2")],
        "earningsDate string, symbol string, epsActual string, epsEstimated string",
    )
    got = {(r["symbol"], r["decision_date"]): r for r in earnings_events(df, shift_days=1).collect()}
    assert set(got) == {("AAA", D(2024, 3, 4)), ("BBB", D(2024, 3, 4))}
    assert got["AAA", D(2024, 3, 4)]["eps_surprise"] == 0.5
    assert got["BBB", D(2024, 3, 4)]["earnings_event"] == 1.0
    no_estimate = earnings_events(df.drop("epsEstimated"), shift_days=0).collect()
    assert all(r["eps_surprise"] is None for r in no_estimate)
