"""From stored prices to a judged portfolio: the steps of a whole study, in order.

Each step is a lazy operator. Tables that later steps read repeatedly are
written below ``out``; the only values that reach the driver are the one-row
verdicts of the gates and the names of columns.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F

from panelkiln.operators import audit, feature_store, folds, labels, metrics, models, portfolio, quality
from panelkiln.sources.tables import write_table


class GateFailed(RuntimeError):
    """A quality or leakage gate said no; ``reasons`` tells why."""

    def __init__(self, gate: str, reasons: Sequence[str]):
        super().__init__(f"{gate}: {'; '.join(reasons)}")
        self.gate, self.reasons = gate, list(reasons)


@dataclass(frozen=True)
class StudyConfig:
    adjusted: bool = False
    lookbacks: Sequence[int] = (1, 5, 20, 60, 120)
    shift_days: int = 1
    use_tickers_for_general: bool = False
    horizon: int = 20
    train: int = 504
    val: int = 126
    test: int = 126
    step: int = 63
    purge: int = 20
    embargo: int = 5
    corr_threshold: float = 0.995
    quality_thresholds: Mapping[str, float] = field(default_factory=dict)
    exclude_prefixes: Sequence[str] = ()
    exclude_patterns: Sequence[str] = ()
    model_params: Mapping = field(default_factory=dict)
    rules: portfolio.PortfolioRules = portfolio.PortfolioRules()
    seed: int = 42

    @property
    def target(self) -> str:
        return f"future_return_{self.horizon}d"


@dataclass(frozen=True)
class Study:
    """Lazy results; features, merged rows and predictions are stored tables."""

    features: DataFrame
    merged: DataFrame
    fold: DataFrame
    feature_names: list[str]
    predictions: DataFrame
    validation_error: DataFrame
    evaluation: DataFrame
    daily: DataFrame
    positions: DataFrame
    summary: DataFrame


def _kept(spark: SparkSession, df: DataFrame, path: str, sort_by: Sequence[str] = ()) -> DataFrame:
    write_table(df, path, sort_by=sort_by)
    return spark.read.schema(df.schema).parquet(path)


def checked_prices(
    prices: DataFrame, config: StudyConfig, splits: DataFrame | None = None, dividends: DataFrame | None = None
) -> DataFrame:
    """Prices without thin symbols, once the quality gate has passed."""
    limits = {**quality.DEFAULTS, **config.quality_thresholds}
    figures = quality.quality_metrics(
        prices, thresholds=limits, adjusted=config.adjusted, splits=splits, dividends=dividends
    )
    verdict = quality.quality_gate(figures, thresholds=limits, adjusted=config.adjusted).first()
    if not verdict["passed"]:
        raise GateFailed("quality", verdict["fail_reasons"])
    thin = quality.thin_symbols(prices, int(limits["min_obs_per_symbol"]))
    return feature_store.without_symbols(prices, thin)


def run_study(
    spark: SparkSession,
    out: str,
    *,
    prices: DataFrame,
    membership: DataFrame,
    earnings: DataFrame | None = None,
    news: DataFrame | None = None,
    splits: DataFrame | None = None,
    dividends: DataFrame | None = None,
    config: StudyConfig = StudyConfig(),
) -> Study:
    usable = checked_prices(prices, config, splits, dividends)
    features = _kept(
        spark,
        feature_store.build_feature_store(
            prices=usable,
            membership=membership,
            earnings=earnings,
            news=news,
            adjusted=config.adjusted,
            lookbacks=config.lookbacks,
            shift_days=config.shift_days,
            use_tickers_for_general=config.use_tickers_for_general,
        ),
        f"{out}/features",
        ["symbol", "decision_date"],
    )
    labelled = labels.build_labels(usable, horizon=config.horizon, adjusted=config.adjusted)
    merged = _kept(
        spark, feature_store.merge_labels(features, labelled), f"{out}/merged", ["decision_date", "symbol"]
    )

    every = folds.walk_forward(
        folds.trading_days(merged), train=config.train, val=config.val, test=config.test, step=config.step
    )
    trimmed = folds.purge_and_embargo(
        every, train=config.train, val=config.val, purge=config.purge, embargo=config.embargo
    )
    fold = _kept(spark, folds.last_fold(trimmed), f"{out}/fold")
    if fold.isEmpty():
        raise GateFailed("folds", ["not enough dates for one fold"])
    names = feature_store.select_features(
        merged.columns, config.target, config.exclude_prefixes, config.exclude_patterns
    )
    verdict = audit.leakage_gate(
        features=features, labels=labelled, merged=merged, fold=fold, feature_names=names, target=config.target,
        threshold=config.corr_threshold,
    ).first()
    if not verdict["passed"]:
        raise GateFailed("leakage", verdict["messages"])

    rows = _kept(spark, models.training_rows(merged, fold, names, config.target), f"{out}/training")
    if rows.filter("is_val").isEmpty() or rows.filter("NOT is_val").isEmpty():
        raise GateFailed("training", ["no finite rows to train or validate on"])
    model = models.fit_boosted_trees(rows, names, params=config.model_params, seed=config.seed)
    models.save(model, f"{out}/model")
    scored = models.score(model, merged, fold, names, config.target, "boosted_trees")
    predictions = _kept(spark, scored, f"{out}/predictions", ["decision_date", "symbol"])

    daily, positions = portfolio.run_portfolio(predictions.filter(F.col("split") == "test"), config.rules)
    return Study(
        features=features,
        merged=merged,
        fold=fold,
        feature_names=names,
        predictions=predictions,
        validation_error=models.validation_error(model, rows),
        evaluation=metrics.evaluate_predictions(predictions),
        daily=daily,
        positions=positions,
        summary=portfolio.portfolio_summary(daily),
    )
