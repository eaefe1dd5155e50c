"""As-of joins against a walk over all pairs."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from panelkiln.operators.asof import asof_join, with_statements

START = dt.date(2023, 1, 2)


def random_sides(seed, keys=3, days=900, left=150, right=120):
    rng = random.Random(seed)
    day = lambda: START + dt.timedelta(days=rng.randrange(days)) if rng.random() > 0.05 else None
    key = lambda: rng.choice([*(f"K{i}" for i in range(keys)), "K0", "K0", None])
    lefts = [(key(), day(), i) for i in range(left)]
    rights = [(key(), day(), rng.choice([None, float(rng.randrange(9))]), rng.choice("ab")) for _ in range(right)]
    return lefts + lefts[:5], rights + rights[:7]


def walk(lefts, rights, equal=True, max_age=None):
    out = []
    for key, at, i in lefts:
        fits = [r for r in rights if None not in (key, at, r[0], r[1]) and r[0] == key and (r[1] <= at if equal else r[1] < at)]
        best = max(fits, key=lambda r: (r[1], r[2] is not None, r[2] or 0.0, r[3]), default=None)
        if best and max_age is not None and (at - best[1]).days > max_age:
            best = None
        out.append((key, at, i, *((best[1], best[2], best[3]) if best else (None, None, None))))
    return sorted(out, key=repr)


@pytest.mark.parametrize("slice_days", [1, 30, 366, 100_000])
@pytest.mark.parametrize(("equal", "max_age"), [(True, None), (False, None), (True, 20)])
def test_asof_join(spark, slice_days, equal, max_age):
    lefts, rights = random_sides(slice_days)
    left = spark.createDataFrame(lefts, "k string, at date, slice int").repartition(3)
    right = spark.createDataFrame(rights, "k string, t date, v double, w string").repartition(3)
    got = asof_join(
        left, right, by=["k"], left_time="at", right_time="t", columns=["v", "w"], matched_time="row", equal=equal, max_age_days=max_age, slice_days=slice_days
    )
    assert got.columns == ["k", "at", "slice", "row", "v", "w"]
    assert sorted(map(tuple, got.collect()), key=repr) == walk(lefts, rights, equal, max_age)


def test_asof_join_by_timestamps_and_without_rows(spark):
    at = lambda s: dt.datetime(2024, 1, 1, 0, 0, s)
    left = spark.createDataFrame([("a", 1, at(5)), ("a", 2, at(5))], "k string, n int, at timestamp")
    right = spark.createDataFrame([("a", 1, at(4), 1.0), ("a", 1, at(6), 2.0)], "k string, n int, t timestamp, v double")
    got = asof_join(left, right, by=["k", "n"], left_time="at", right_time="t", columns=["v"], matched_time="m").orderBy("n").collect()
    assert [(r.n, r.m, r.v) for r in got] == [(1, at(4), 1.0), (2, None, None)]
    assert asof_join(left.limit(0), right, by=["k"], left_time="at", right_time="t", columns=["v"]).count() == 0
    assert [r.v for r in asof_join(left, right.limit(0), by=["k"], left_time="at", right_time="t", columns=["v"]).collect()] == [None, None]


def test_a_hot_key_is_many_groups(spark):
    left = spark.range(4000).selectExpr("'k' AS k", "date_add(DATE'2000-01-01', CAST(id AS INT)) AS at")
    right = left.where("dayofmonth(at) = 1").select("k", F.col("at").alias("t"), F.month("at").cast("double").alias("v"))
    got = asof_join(left, right, by=["k"], left_time="at", right_time="t", columns=["v"], slice_days=30)
    assert got.where("v <> month(at)").count() == 0 and got.count() == 4000
    assert "slice" in got._jdf.queryExecution().executedPlan().toString().split("Window")[1]


def test_statements_count_from_the_day_after_they_are_published(spark):
    friday = dt.date(2024, 1, 5)
    rows = [("a", "income", "2024-01-05", None, 5.0, None), ("A", "income", None, "2024-02-01", None, None), ("A", "balance", "2024-01-10", None, None, 9.0)]
    statements = spark.createDataFrame(rows, "symbol string, statement_type string, fillingDate string, date string, revenue double, assets double")
    days = [friday, *(dt.date(2024, 1, d) for d in (8, 11, 31)), dt.date(2024, 2, 2)]
    panel = spark.createDataFrame([("A", d) for d in days] + [("B", friday)], "symbol string, decision_date date")
    got = with_statements(panel, statements, {"revenue": ("income", "revenue"), "assets": ("balance", "assets")}).orderBy("symbol", "decision_date")
    want = [(None, None, None), (5.0, None, 0), (5.0, 9.0, 0), (5.0, 9.0, 20), (None, 9.0, 0), (None, None, None)]
    assert [(r.revenue, r.assets, r.statement_age) for r in got.collect()] == want
