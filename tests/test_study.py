import math

import pytest
from pyspark.sql import functions as F

from panelkiln.operators.portfolio import PortfolioRules
from panelkiln.plans.study import GateFailed, StudyConfig, run_study
from panelkiln.session import fresh_folder
from tests.helpers import PRICE_SCHEMA, frame, weekdays

CONFIG = StudyConfig(
    lookbacks=(1, 5, 20), horizon=1, train=48, val=16, test=25, step=25, purge=1, embargo=1,
    quality_thresholds={"min_obs_per_symbol": 60, "min_symbols_after_filter": 6},
    exclude_prefixes=("corr_",), model_params={"maxIter": 6, "maxDepth": 2, "minInstancesPerNode": 1},
    rules=PortfolioRules(topn=2, max_names=2),
)


def panel():
    """Seven names on slow waves of different phase, all drifting upwards."""
    rows = []
    for k, name in enumerate(("ASH", "ELM", "FIR", "IVY", "OAK", "SOY", "YEW")):
        for t, day in enumerate(weekdays("2023-03-06", 150)):
            close = 20.0 * (k + 2) * math.exp(0.002 * t + 0.03 * math.sin(t / 9.0 + k))
            rows.append(
                {"symbol": name, "date": day, "open": close - 0.1, "high": close + 0.4, "low": close - 0.3, "close": close,
                 "adj_close": 0.9 * close, "volume": 5000.0 * (2 + math.cos(t / 4.0 + k))}
            )
    return rows


def members(prices):
    return prices.select("date", "symbol", F.lit(True).alias("is_member")).distinct()


def test_study_runs_from_prices_to_portfolio(spark):
    prices = frame(spark, panel(), PRICE_SCHEMA).cache()
    news = spark.createDataFrame([("2023-07-03", "OAK", "strong growth")], "date string, symbol string, title string")
    study = run_study(spark, fresh_folder(spark, "study"), prices=prices, membership=members(prices), news=news, config=CONFIG)
    assert "corr_mkt_20d" not in study.feature_names and "news_count_20d" in study.feature_names
    assert {r["split"] for r in study.predictions.select("split").distinct().collect()} == {"train", "val", "test"}
    row = study.summary.first()
    assert row["days"] == 24 and row["total_return"] > 0
    assert study.positions.count() == 24 * 2
    assert study.evaluation.filter("split = 'test' AND kind = 'rank_ic'").first()["n"] == 24
    assert study.validation_error.first()["mse"] < 1e-4


def test_bad_prices_stop_the_study(spark):
    rows = panel()
    prices = frame(spark, rows + rows[:20], PRICE_SCHEMA)
    with pytest.raises(GateFailed) as stop:
        run_study(spark, fresh_folder(spark, "study"), prices=prices, membership=members(prices), config=CONFIG)
    assert stop.value.gate == "quality" and stop.value.reasons[0].startswith("duplicates_ratio")


def test_too_few_days_stop_the_study(spark):
    prices = frame(spark, [r for r in panel() if r["date"].month < 6], PRICE_SCHEMA)
    with pytest.raises(GateFailed) as stop:
        run_study(spark, fresh_folder(spark, "study"), prices=prices, membership=members(prices), config=CONFIG)
    assert stop.value.gate == "folds"
