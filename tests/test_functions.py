import datetime as dt

import pandas as pd
from pyspark.sql import functions as F

from panelkiln.functions import columns, dates, frames, numeric, text


def _one(spark, *exprs):
    return spark.range(1).select(*exprs).first()


def test_business_day_add_equals_pandas(spark):
    days = [dt.date(2024, 2, 19) + dt.timedelta(days=i) for i in range(21)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    shifted = df.select("d", *[dates.add_business_days(F.col("d"), n).alias(str(n)) for n in range(11)]).collect()
    for row in shifted:
        for n in range(11):
            assert row[str(n)] == (pd.Timestamp(row["d"]) + pd.offsets.BDay(n)).date(), (row["d"], n)


def test_business_calendar_and_iso_week(spark):
    row = _one(
        spark,
        dates.business_days(dt.date(2024, 2, 29), dt.date(2024, 3, 5)).alias("days"),
        dates.business_days(dt.date(2024, 3, 2), dt.date(2024, 3, 3)).alias("weekend"),
        dates.business_days(dt.date(2024, 3, 5), dt.date(2024, 3, 1)).alias("reversed"),
        dates.iso_week(F.lit(dt.date(2024, 12, 30))).alias("week"),
    )
    assert [d.day for d in row["days"]] == [29, 1, 4, 5]
    assert row["weekend"] == [] and row["reversed"] == []
    assert row["week"] == 202501


def test_bad_values_become_null(spark):
    rows = spark.createDataFrame([("1.5",), ("n/a",), ("nan",), (None,)], "v string")
    assert [r[0] for r in rows.select(numeric.number("v")).collect()] == [1.5, None, None, None]
    texts = spark.createDataFrame([("",), ("   ",), ("not-a-date",), ("2026-02-21",), ("2026-02-21 10:00:00",)], "v string")
    day = dt.date(2026, 2, 21)
    assert [r[0] for r in texts.select(dates.day("v")).collect()] == [None, None, None, day, day]


def test_numeric_guards(spark):
    row = _one(
        spark,
        numeric.ratio(F.lit(1.0), F.lit(0.0)).alias("zero"),
        numeric.log(F.lit(-1.0)).alias("log"),
        numeric.clip(F.lit(None).cast("double"), -1, 1).alias("clip_null"),
        numeric.clip(F.lit(7.0), -1, 1).alias("clip"),
        numeric.finite(F.lit(float("inf"))).alias("inf"),
        numeric.finite(F.lit(float("nan"))).alias("nan"),
        numeric.finite(F.lit(1)).alias("one"),
    )
    assert row.asDict() == {
        "zero": None, "log": None, "clip_null": None, "clip": 1.0, "inf": False, "nan": False, "one": True,
    }


def test_scoring_filter_lets_infinities_pass(spark):
    df = spark.createDataFrame([(1.0,), (float("inf"),), (float("nan"),), (None,)], "x double")
    assert df.filter(numeric.all_finite(["x"])).count() == 1
    assert df.filter(numeric.all_present(["x"])).count() == 2


def test_correlation_of_a_constant_is_null(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 2.0), (3.0, 2.0)], "x double, y double")
    assert df.agg(frames.correlation(F.col("x"), F.col("y"))).first()[0] is None


def test_alias_choice(spark):
    df = spark.createDataFrame([(None, "x", 1.0), (None, "2", 2.0)], "a string, b string, c double")
    assert columns.first_present(df, ["z", "b", "c"]) == "b"
    assert columns.first_with_data(df, ["z", "a", "b", "c"]) == "b"
    assert columns.first_with_data(df, ["a"]) is None
    values = df.select(columns.first_value(df, ["b", "c"], numeric.number)).collect()
    assert [r[0] for r in values] == [1.0, 2.0]


def test_price_column(spark):
    some = spark.createDataFrame([(1.0, 2.0), (1.0, None)], "close double, adj_close double")
    none = some.withColumn("adj_close", F.lit(None).cast("double"))
    assert columns.price_column(some, True) == "adj_close"
    assert columns.price_column(some, False) == "close"
    assert columns.price_column(none, True) == "close"
    assert columns.price_column(some.drop("adj_close"), True) == "close"


def test_ticker_lists(spark):
    cases = {
        "NASDAQ:BBB,NYSE:CCC": ["BBB", "CCC"],
        " brk.b | brk.b;bf-b ": ["BRK.B", "BF-B"],
        "A/B\\C": ["A", "B", "C"],
        "general, aapl": ["GENERAL", "AAPL"],
        "Nan": [],
        "none": [],
        "  ": [],
        "way-too-long-symbol": [],
        "x:y:z": ["Z"],
    }
    df = spark.createDataFrame([(k,) for k in cases] + [(None,)], "v string")
    got = {r["v"]: r["t"] for r in df.select("v", text.tickers(F.col("v")).alias("t")).collect()}
    assert got == {**cases, None: []}
    dropped = df.filter("v like 'general%'").select(text.tickers(F.col("v"), drop_placeholders=True)).first()[0]
    assert dropped == ["AAPL"]
    assert df.filter("v is null").select(text.first_ticker(F.col("v"))).first()[0] == "GENERAL"


def test_ticker_from_json(spark):
    cases = [
        ("aapl", "AAPL"), ("BRK.B", "BRK.B"), ("BLOCK, INC.", None), ("AIRBNB INC", None), (None, None),
        ('{"symbol": "msft"}', "MSFT"), ('{"symbol": "Some Name", "ticker": "ibm"}', "IBM"), ("{}", None),
    ]
    df = spark.createDataFrame(cases, "v string, want string")
    for row in df.select("want", text.ticker_from_json(F.col("v")).alias("got")).collect():
        assert row["got"] == row["want"]


def test_sentiment(spark):
    cases = [
        ("Strong growth, weak outlook", 0.25), ("beats beats miss", 1 / 3), ("12 34", None), ("", None), ("plain words", 0.0),
    ]
    df = spark.createDataFrame([(t,) for t, _ in cases], "t string")
    got = [r[0] for r in df.select(text.sentiment(F.col("t"))).collect()]
    assert got == [w for _, w in cases]
    joined = _one(spark, text.join_text(F.lit("a"), F.lit(None), F.lit("b")).alias("x"))["x"]
    assert joined == "a  b"
