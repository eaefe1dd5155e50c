import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from panelkiln.operators import feature_store, labels, price_features
from tests.helpers import PRICE_SCHEMA, assert_close, frame, random_prices, table

LOOKBACKS = (1, 3, 20)


def expected_features(rows, lookbacks):
    """One value at a time, from plain lists of each symbol's earlier rows."""
    df = pd.DataFrame(rows).sort_values(["symbol", "date"])
    market = df.groupby("date")["close"].mean()
    out = []
    for symbol, g in df.groupby("symbol"):
        g = g.reset_index(drop=True)
        close = g["close"].astype(float)
        px = close.ffill().tolist()
        mk = market.reindex(g["date"]).ffill().tolist()
        vol = [v if v else np.nan for v in g["volume"]]

        def ret(series, i, k):
            return series[i] / series[i - k] - 1 if i - k >= 0 else np.nan

        raw = [ret(px, i, 1) for i in range(len(g))]
        mkt = [ret(mk, i - 1, 1) if i >= 1 else np.nan for i in range(len(g))]
        rng = ((g["high"] - g["low"]) / close).tolist()
        dollar = [v * p for v, p in zip(vol, close)]
        for i in range(1, len(g)):
            row = {"symbol": symbol, "decision_date": g["date"][i], "feature_available_date": g["date"][i - 1]}
            for k in lookbacks:
                row[f"ret_{k}d"] = ret(px, i - 1, k)

            def window(values):
                part = np.array(values[max(0, i - 20):i], dtype=float)
                return part if len(part) == 20 and not np.isnan(part).any() else None

            w = window([np.log(r + 1) for r in raw])
            row["vol_20d"] = np.std(w, ddof=1) if w is not None else np.nan
            w = window(rng)
            row["range_20d"] = w.mean() if w is not None else np.nan
            w = window(dollar)
            row["adv20_dollar"] = w.mean() if w is not None else np.nan
            w = window(vol)
            row["volume_z_20d"] = (w[-1] - w.mean()) / (np.std(w, ddof=1) + 1e-12) if w is not None else np.nan
            a, b = window(raw), window(mkt)
            row["corr_mkt_20d"] = np.corrcoef(a, b)[0, 1] if a is not None and b is not None else np.nan
            out.append(row)
    return pd.DataFrame(out).sort_values(["symbol", "decision_date"]).reset_index(drop=True)


def test_price_features_against_row_by_row_values(spark):
    rows = random_prices(seed=1, nulls=0.01) + [
        {**r, "symbol": "T" + r["symbol"], "volume": r["volume"] + 50} for r in random_prices(seed=2, nulls=0.0)
    ]
    built = price_features.build_price_features(frame(spark, rows, PRICE_SCHEMA), lookbacks=LOOKBACKS)
    got, want = table(built, "symbol", "decision_date"), expected_features(rows, LOOKBACKS)
    names = [f"ret_{k}d" for k in LOOKBACKS] + ["corr_mkt_20d", "vol_20d", "range_20d", "adv20_dollar", "volume_z_20d"]
    assert_close(got, want, names, tol=1e-8)
    assert want["corr_mkt_20d"].notna().any() and want["volume_z_20d"].notna().any()
    assert (got["feature_available_date"] == want["feature_available_date"]).all()
    assert "ret_1d_raw" not in built.columns


def test_no_look_ahead_and_row_order_is_irrelevant(spark):
    rows = random_prices(seed=3)
    full = price_features.build_price_features(frame(spark, rows, PRICE_SCHEMA), lookbacks=LOOKBACKS)
    cut = sorted({r["date"] for r in rows})[45]
    early = [r for r in rows if r["date"] <= cut]
    truncated = price_features.build_price_features(
        frame(spark, early[::-1], PRICE_SCHEMA).repartition(7), lookbacks=LOOKBACKS
    )
    a = table(full.filter(F.col("decision_date") <= F.lit(cut)), "symbol", "decision_date")
    b = table(truncated, "symbol", "decision_date")
    assert_close(a, b, [c for c in a.columns if c.startswith(("ret", "vol", "corr", "range", "adv"))])


def test_same_day_return_is_opt_in_and_momentum_needs_both(spark):
    df = frame(spark, random_prices(seed=4, symbols=1), PRICE_SCHEMA)
    built = price_features.build_price_features(df, lookbacks=(20, 60), include_raw_return=True)
    assert {"ret_1d_raw", "mom_20_60"} <= set(built.columns)
    assert "mom_20_60" not in price_features.build_price_features(df, lookbacks=(20,)).columns


def test_optional_columns_may_be_missing(spark):
    df = frame(spark, random_prices(seed=5, symbols=1, nulls=0), PRICE_SCHEMA).select("symbol", "date", "close")
    row = price_features.build_price_features(df, lookbacks=(1,)).agg(
        F.count("range_20d"), F.count("adv20_dollar"), F.count("vol_20d")
    ).first()
    assert row[0] == 0 and row[1] == 0 and row[2] > 0


def test_window_plan_has_one_shuffle_by_symbol(spark, tmp_path):
    frame(spark, random_prices(seed=6), PRICE_SCHEMA).write.parquet(str(tmp_path / "p"))
    prices = spark.read.parquet(str(tmp_path / "p"))
    plan = price_features.build_price_features(prices, lookbacks=(1, 5))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("hashpartitioning(symbol") == 1
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_labels_look_exactly_h_rows_ahead(spark):
    rows = random_prices(seed=7, symbols=2, nulls=0.0)
    got = table(labels.build_labels(frame(spark, rows, PRICE_SCHEMA), horizon=3), "symbol", "decision_date")
    df = pd.DataFrame(rows).sort_values(["symbol", "date"])
    df["label_date"] = df.groupby("symbol")["date"].shift(-3)
    df["y"] = df.groupby("symbol")["close"].shift(-3) / df["close"] - 1
    want = df.dropna(subset=["label_date", "y"]).reset_index(drop=True)
    assert (got["label_date"].values == want["label_date"].values).all()
    np.testing.assert_allclose(got["future_return_3d"].to_numpy(float), want["y"].to_numpy(float))
    assert (got["label_date"] > got["decision_date"]).all()
    with pytest.raises(ValueError):
        labels.build_labels(frame(spark, rows, PRICE_SCHEMA), horizon=0)


def test_label_summary(spark):
    built = labels.build_labels(frame(spark, random_prices(seed=8), PRICE_SCHEMA), horizon=20)
    row = labels.label_summary(built, "future_return_20d").first()
    assert row["rows"] == built.count() and row["nan_ratio"] == 0.0


def test_feature_selection():
    columns = ["decision_date", "symbol", "ret_1d", "ret_5d", "vol_20d", "y", "horizon"]
    assert feature_store.select_features(columns, "y", ["vol_"], [r"5d$"]) == ["ret_1d"]
    with pytest.raises(ValueError):
        feature_store.select_features(columns, "y", exclude_patterns=["("])
    with pytest.raises(ValueError):
        feature_store.select_features(columns, "y", exclude_prefixes=["ret_", "vol_"])


def test_excluded_symbols_ignore_case(spark):
    df = spark.createDataFrame([("aaa",), ("BBB",), ("ccc",)], "symbol string")
    out = spark.createDataFrame([(" AAA",), ("bbb ",), ("bbb",)], "symbol string")
    assert [r[0] for r in feature_store.without_symbols(df, out).collect()] == ["ccc"]


def test_labels_in_the_feature_pass_equal_the_join(spark):
    prices = frame(spark, random_prices(seed=9), PRICE_SCHEMA)
    features = price_features.build_price_features(prices, lookbacks=(1, 3))
    joined = feature_store.merge_labels(features, labels.build_labels(prices, horizon=4))
    single = price_features.build_price_features(prices, lookbacks=(1, 3), label_horizon=4)
    assert sorted(single.columns) == sorted(joined.columns)
    a, b = table(single, "symbol", "decision_date"), table(joined, "symbol", "decision_date")
    assert (a["label_date"] == b["label_date"]).all()
    assert_close(a, b, ["ret_3d", "vol_20d", "future_return_4d"])
    plan = single._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan
