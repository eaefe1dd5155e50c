"""What keeps the cost of a step from growing faster than its input: plans without needless sorts and shuffles, and that results stay."""

import datetime
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelkiln.functions.frames import correlation_of, deviation_of, history, mean_of, trailing
from panelkiln.operators import price_features, universe
from panelkiln.operators.rows import keep_first, keep_last
from panelkiln.plans import adapters
from panelkiln.sources import landing


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("n", [1, 2, 5, 20])
def test_trailing_figures_are_those_of_the_frame(spark, n):
    rng = random.Random(n)
    rows = [(s, i, None if rng.random() < 0.03 else rng.choice([5.0, rng.uniform(1e6, 1e6 + 1)]), rng.random()) for s in "ab" for i in range(90)]
    rows += [("c", i, 0.1, float(i)) for i in range(40)]  # equal values: exactly no spread, so no correlation
    df = spark.createDataFrame(rows, "symbol string, date int, x double, y double")
    got = trailing(df, history("date"), n, sums=["y"], spreads=["x", "y"], pairs=[("x", "y")], name="m")
    columns = {"mean": mean_of("m", "y", n), "corr": correlation_of("m", "x", "y", n), "square": F.col("m.square_x")}
    if n > 1:
        columns["deviation"] = deviation_of("m", "x", n)
    found = {(r.symbol, r.date): r for r in got.withColumns(columns).collect()}
    assert len(found) == len(rows)
    for s, i, *_ in rows:
        own = [(x, y) for t, j, x, y in rows if t == s and i - n <= j < i]
        r = found[s, i]
        assert (r["mean"] is None) == (len(own) < n)
        if len(own) < n:
            continue
        assert r["mean"] == pytest.approx(np.mean([y for _, y in own]))
        if any(x is None for x, _ in own):
            assert r.square is None and r["corr"] is None
            continue
        x, y = np.array(own).T
        assert r.square == pytest.approx(((x - x.mean()) ** 2).sum(), rel=1e-6, abs=1e-9)
        if (x == x[0]).all():
            assert r.square == 0 and r["corr"] is None
        elif n > 2:
            assert r.deviation == pytest.approx(x.std(ddof=1), rel=1e-6)
            assert r["corr"] == pytest.approx(np.corrcoef(x, y)[0, 1], rel=1e-6, abs=1e-9)


def test_features_aggregate_no_sliding_frame(spark):
    prices = spark.createDataFrame([("a", datetime.date(2020, 1, 1), 1.0)], "symbol string, date date, close double")
    plan = plan_of(price_features.build_price_features(prices, lookbacks=(1, 5), label_horizon=5))
    assert not re.search(r"(avg|stddev_samp|stddev_pop|covar_pop|count)\([^)]*\) windowspecdefinition", plan)


def test_bars_are_sorted_once_and_after_they_moved(spark):
    rows = [(1, d, k, 1, 2.0, 3.0 + k, 0.1, "R") for d in ("2020-01-01", "2020-01-02") for k in (3, 1, 2, 1)]
    lines = spark.createDataFrame(rows, "l_suppkey long, l_shipdate string, l_orderkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_returnflag string")
    bars = adapters._bars(adapters._lines(lines), adapters.LINE_ORDER)
    plan = plan_of(bars)
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("Sort [") == 1
    assert plan.index("Sort [") < plan.index("Exchange hashpartitioning")  # above it
    assert {(r.open, r.high, r.close, r.volume) for r in bars.collect()} == {(2.0, 3.0, 3.0, 8.0)}


def test_members_are_counted_without_sorting_their_days(spark, monkeypatch):
    day = datetime.date
    spans = [("b", day(2020, 1, 1), day(2020, 1, 3)), ("é", day(2020, 1, 2), day(2020, 1, 6)), ("a", day(2020, 1, 6), day(2020, 1, 6)), (None, day(2020, 1, 6), day(2020, 1, 7))]
    plans = []
    monkeypatch.setattr(universe, "stored", lambda df, label: plans.append((label, plan_of(df))) or df)
    got = universe.members_by_day(spark.createDataFrame(spans, "symbol string, from_date date, to_date date"))
    want = {(day(2020, 1, 1), 1, "b", "b"), (day(2020, 1, 2), 2, "b", "é"), (day(2020, 1, 3), 2, "b", "é"), (day(2020, 1, 6), 3, "a", "é"), (day(2020, 1, 7), 1, None, None)}
    assert {tuple(r) for r in got.collect()} == want
    assert "SortAggregate" not in dict(plans)["days"]


def test_a_row_that_is_its_own_order_travels_once(spark):
    rows = [(k, i % 3, None if i % 4 == 0 else i % 5) for k in (1, None) for i in range(30)]
    df = spark.createDataFrame(rows, "k int, p int, q int")
    for keep in (keep_first, keep_last):
        by_name, by_column = keep(df, ["k"], ["p", "k", "q"]), keep(df, ["k"], [F.col("p"), F.col("k"), F.col("q")])
        assert by_name.columns == by_column.columns
        assert sorted(by_name.collect(), key=str) == sorted(by_column.collect(), key=str)
        assert plan_of(by_name).count("_by(") == 0 < plan_of(by_column).count("_by(")


def test_envelopes_are_gathered_after_one_shuffle(spark):
    rows = spark.createDataFrame([("a", datetime.date(2020 + i % 2, 1, 1 + i), float(i)) for i in range(6)], "symbol string, date date, close double")
    envelopes = landing.as_envelopes(rows)
    plan = plan_of(envelopes)
    assert "ObjectHashAggregate" not in plan[plan.index("Exchange hashpartitioning") :]
    assert sorted(len(r.data) for r in envelopes.collect()) == [3, 3]
