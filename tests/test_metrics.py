import datetime as dt
import math

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from panelkiln import session
from panelkiln.operators import metrics, rows as row_ops

SCHEMA = "decision_date date, symbol string, y_pred double, y_true double"


def predictions(seed=0):
    rng = np.random.default_rng(seed)
    out = []
    for i in range(12):
        day = dt.date(2024, 1, 1) + dt.timedelta(days=i)
        # Day 3 holds most rows, and one score holds half of them.
        for s in range(400 if i == 3 else rng.integers(1, 12)):
            p = 0.5 if rng.random() < 0.5 else float(rng.normal())
            y = None if rng.random() < 0.05 else float(rng.integers(-3, 4))
            out.append((day, f"S{s}", p, y))
    return out


def expected(rows, method):
    df = pd.DataFrame(rows, columns=["d", "s", "p", "y"]).dropna(subset=["p", "y"])
    out = {}
    for day, g in df.groupby("d"):
        if len(g) >= 3:
            a, b = (g["p"].rank(), g["y"].rank()) if method == "spearman" else (g["p"], g["y"])
            ic = np.corrcoef(a, b)[0, 1] if a.nunique() > 1 and b.nunique() > 1 else np.nan
            if np.isfinite(ic):
                out[day] = (len(g), ic)
    return out


def compare(df, want):
    got = {r["decision_date"]: (r["n"], r["ic"]) for r in df.collect()}
    assert set(got) == set(want)
    for day, (n, ic) in want.items():
        assert got[day][0] == n and abs(got[day][1] - ic) < 1e-9


def test_daily_ic(spark):
    rows = predictions()
    compare(metrics.daily_ic(spark.createDataFrame(rows, SCHEMA)), expected(rows, "pearson"))


def test_rank_ic_in_one_range_and_in_many_agree(spark):
    rows = predictions()
    df = spark.createDataFrame(rows, SCHEMA)
    want = expected(rows, "spearman")
    compare(metrics.daily_rank_ic(df), want)
    compare(metrics.daily_rank_ic(df, range_rows=1), want)
    compare(metrics.daily_rank_ic(df, range_rows=3), want)


def test_one_day_with_all_rows_is_split(spark):
    df = spark.range(5000).select(F.lit("d").alias("g"), F.col("id").cast("double").alias("v"), F.lit(1).alias("w"))
    ranked = row_ops.spread_ranks(df, "g", "v", "w", buckets=10)
    assert sorted(r["rank"] for r in ranked.collect()) == [float(i + 1) for i in range(5000)]
    top = row_ops.top_rows(df, "g", [F.col("v").desc()], 700, F.col("v"))
    assert sorted(r["v"] for r in top.collect()) == [float(i) for i in range(4300, 5000)]


def test_spread_ranks_split_a_hot_group(spark):
    cells = spark.range(1000).select(F.lit("d").alias("g"), F.col("id").cast("double").alias("v"), F.lit(2).alias("w"))
    ranked = row_ops.spread_ranks(cells, "g", "v", "w", buckets=16)
    got = {r["v"]: r["rank"] for r in ranked.collect()}
    assert got == {float(i): 2 * i + 1.5 for i in range(1000)}


def test_ranks_of_hot_groups_and_hot_ties(spark):
    """A value that a third of the rows share, identical rows, small groups: the same ranks wherever the cuts fall."""
    rng = np.random.default_rng(5)
    rows = [("hot", float(v), float(w)) for v, w in zip(rng.integers(0, 60, 900), rng.normal(size=900))]
    rows += [("hot", 7.0, 0.5)] * 600 + [("small", 1.0, 2.0), ("small", 1.0, 1.0), ("small", 0.0, 3.0), ("one", 4.0, 4.0)]
    df = session.stored(spark.createDataFrame(rows, "g string, v double, w double").repartition(3))
    for range_rows in (1, 40, 500, 50_000):
        got = {}
        for r in row_ops.with_ranks(df, "g", ["v", "w"], range_rows).collect():
            got.setdefault(r.g, []).append((r.v, r.w, r.v_rank, r.w_rank, r.group_size))
        for g, mine in got.items():
            own = [(v, w) for k, v, w in rows if k == g]
            assert len(mine) == len(own) and {m[4] for m in mine} == {len(own)}
            for at in (0, 1):
                every = np.array([x[at] for x in own])
                for m in mine:
                    assert m[2 + at] == (every < m[at]).sum() + ((every == m[at]).sum() + 1) / 2


def test_evaluation_by_model_and_split(spark):
    rows = predictions()
    df = spark.createDataFrame(rows, SCHEMA).withColumn("model_name", F.lit("m")).withColumn(
        "split", F.when(F.col("decision_date") < "2024-01-06", "train").otherwise("test")
    )
    got = {(r["split"], r["kind"]): r for r in metrics.evaluate_predictions(df).collect()}
    want = [ic for day, (_, ic) in sorted(expected(rows, "spearman").items()) if day >= dt.date(2024, 1, 6)]
    row = got["test", "rank_ic"]
    assert row["n"] == len(want)
    np.testing.assert_allclose(row["daily"], want, atol=1e-9)
    assert abs(row["mean"] - np.mean(want)) < 1e-9 and abs(row["std"] - np.std(want, ddof=1)) < 1e-9


def test_series_figures(spark):
    def row(values):
        df = spark.createDataFrame([(v,) for v in values], "x double")
        return df.agg(*metrics.series_summary("x"), metrics.sharpe("x").alias("sharpe")).first()

    assert tuple(row([])) == (0, None, None, None)
    assert tuple(row([0.5])) == (1, 0.5, 0.0, None)
    assert row([0.1, 0.1])["sharpe"] is None
    r = row([0.1, -0.05, None, 0.02])
    x = np.array([0.1, -0.05, 0.02])
    assert r["n"] == 3 and abs(r["sharpe"] - x.mean() / x.std(ddof=1) * math.sqrt(252)) < 1e-9


def test_drawdown_handles_total_loss(spark):
    returns = [0.1, -0.2, -1.5, 0.3]
    df = spark.createDataFrame([(i, r) for i, r in enumerate(returns)], "date int, net_return double")
    got = metrics.with_drawdown(df).orderBy("date").collect()
    equity = np.cumprod(1 + np.array(returns))
    np.testing.assert_allclose([r["equity"] for r in got], equity)
    np.testing.assert_allclose([r["drawdown"] for r in got], equity / np.maximum.accumulate(equity) - 1)
