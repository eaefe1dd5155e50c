"""Training and scoring with Spark ML."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from datetime import date
from functools import reduce

from pyspark import SparkContext, inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressionModel, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession, functions as F

from panelkiln.functions.numeric import all_finite, all_present
from panelkiln.operators import folds, portfolio
from panelkiln.operators.folds import tag_parts
from panelkiln.operators.metrics import evaluate_predictions, mean_squared_error
from panelkiln.operators.sweep import candidate_score, run_gate
from panelkiln.session import Scratch, stored

KEY = ["decision_date", "symbol"]
COST_COLUMNS = ("adv20_dollar", "vol_20d")

# Default learner settings: depth 5 grows up to 32 leaves per tree. The learner's own stop rule is
# not used: its tolerance is absolute for small errors, and return-sized ones never exceed it.
GBT_PARAMS = {
    "maxIter": 1500,
    "stepSize": 0.05,
    "maxDepth": 5,
    "subsamplingRate": 0.9,
    "featureSubsetStrategy": "0.8",
    "minInstancesPerNode": 20,
}


def training_rows(merged: DataFrame, fold: DataFrame, features: Sequence[str], target: str) -> DataFrame:
    """Train and validation rows with finite inputs and target; ``is_val`` marks validation."""
    rows = tag_parts(merged.filter(all_finite([*features, target])), fold)
    return rows.filter(F.col("split").isin("train", "val")).select(
        *KEY,
        *[F.col(c).cast("double").alias(c) for c in features],
        F.col(target).cast("double").alias("y_true"),
        (F.col("split") == "val").alias("is_val"),
    )


def _fit(learner, rows: DataFrame, features: Sequence[str]) -> PipelineModel:
    assembler = VectorAssembler(inputCols=list(features), outputCol="inputs")
    return Pipeline(stages=[assembler, learner]).fit(rows)


#: Trees in a row without a better validation error after which boosting ends, and trees between two looks at it.
PATIENCE = 50
BLOCK = 10


def _model_of(trees: Sequence, weights: Sequence[float], n_features: int) -> GBTRegressionModel:
    """An ensemble of trees that were fitted one by one, as Spark's own model, so that it is saved, loaded and evaluated as such."""
    gateway = SparkContext._active_spark_context._gateway
    java = gateway.jvm.org.apache.spark.ml
    array = gateway.new_array(java.regression.DecisionTreeRegressionModel, len(trees))
    numbers = gateway.new_array(gateway.jvm.double, len(trees))
    for i, (tree, weight) in enumerate(zip(trees, weights)):
        array[i], numbers[i] = tree._java_obj, float(weight)
    model = java.regression.GBTRegressionModel(java.util.Identifiable.randomUID("gbtr"), array, numbers, n_features)
    for name, value in (("featuresCol", "inputs"), ("labelCol", "y_true"), ("predictionCol", "y_pred")):
        model.set(model.getParam(name), value)
    return GBTRegressionModel(model)


def fit_boosted_trees(
    rows: DataFrame,
    features: Sequence[str],
    *,
    params: Mapping | None = None,
    seed: int = 42,
    patience: int = PATIENCE,
    block: int = BLOCK,
) -> PipelineModel:
    """Boosted regression trees on the training rows, cut at the tree with the least validation error.

    Every tree is fitted once, to what the trees before it leave (for the first one, the target itself; for others the gradient of the
    squared error, taken by ``stepSize``). After each ``block`` of trees the predictions so far are stored beside
    the rows, and the validation error after every one of them is taken in one pass; boosting ends once the best tree lies
    ``patience`` trees back, or with ``maxIter``. The model is the trees up to the best one. Without validation rows
    all ``maxIter`` trees stay. At any time one stored copy of the inputs is held, and no more than a block of trees is applied in a pass.
    """
    settings = {**GBT_PARAMS, **(params or {})}
    most, step = settings.pop("maxIter"), settings.pop("stepSize")
    assembler = VectorAssembler(inputCols=list(features), outputCol="inputs")
    data = assembler.transform(rows).select("inputs", "y_true", "is_val", F.lit(0.0).alias("margin"))
    held = Scratch(rows.sparkSession)
    data = held.stored(data, "boosting")
    has_validation = not data.filter("is_val").isEmpty()
    trees, errors = [], []

    def weight(k: int) -> float:
        return step if k else 1.0

    while len(trees) < most:
        margins, own, start = [F.col("margin")], data, len(trees)
        for k in range(start, min(start + block, most)):
            rest = F.col("y_true") - margins[-1]
            target = own.filter(~F.col("is_val")).withColumn("rest", rest * F.lit(2.0 if k else 1.0))
            learner = RandomForestRegressor(featuresCol="inputs", labelCol="rest", predictionCol=f"tree_{k}", numTrees=1, bootstrap=False, seed=seed + k)
            tree = learner.setParams(**settings).fit(target.select("inputs", "rest")).trees[0]
            trees.append(tree.setFeaturesCol("inputs").setPredictionCol(f"tree_{k}"))
            own = tree.transform(own)
            margins.append(margins[-1] + F.col(f"tree_{k}") * F.lit(weight(k)))
        following = Scratch(rows.sparkSession)
        if has_validation:
            sums = [F.avg(F.pow(F.col("y_true") - m, 2)) for m in margins[1:]]
            errors += own.filter("is_val").agg(*sums).first()
            if len(trees) - (errors.index(min(errors)) + 1) >= patience:
                break
        if len(trees) < most:
            data = following.stored(own.select("inputs", "y_true", "is_val", margins[-1].alias("margin")), "boosting")
        held.clear()
        held = following
    held.clear()
    best = errors.index(min(errors)) + 1 if errors else len(trees)
    return PipelineModel([assembler, _model_of(trees[:best], [weight(k) for k in range(best)], len(features))])


def fit_linear(rows: DataFrame, features: Sequence[str]) -> PipelineModel:
    """Least squares with an intercept, on the training rows."""
    learner = LinearRegression(
        featuresCol="inputs", labelCol="y_true", predictionCol="y_pred", solver="normal", regParam=0.0,
        standardization=False,
    )
    return _fit(learner, rows.filter(~F.col("is_val")), features)


def validation_error(model: PipelineModel, rows: DataFrame) -> DataFrame:
    return mean_squared_error(model.transform(rows.filter("is_val")))


def score(
    model: PipelineModel, merged: DataFrame, fold: DataFrame, features: Sequence[str], target: str, model_name: str
) -> DataFrame:
    """Predictions for every row of the fold with all inputs present."""
    rows = tag_parts(merged.filter(all_present(list(features))), fold)
    costs = [c for c in COST_COLUMNS if c in merged.columns]
    typed = rows.withColumns({c: F.col(c).cast("double") for c in features})
    return model.transform(typed).select(
        F.lit(model_name).alias("model_name"), "split", *KEY, F.col(target).alias("y_true"), "y_pred", *costs
    )


def save(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load(path: str) -> PipelineModel:
    return PipelineModel.load(path)


#: Candidates whose jobs are in flight at once.
PARALLEL = 4


def side_by_side(spark: SparkSession, run: Callable, items: Iterable, parallel: int = PARALLEL) -> list:
    """``run`` of each item, ``parallel`` at a time, each in a scheduler pool of its own; results in the order of the items.

    One fit leaves the cluster idle between its many short jobs, which those of others fill. With
    ``spark.scheduler.mode`` FAIR the pools share it evenly, with FIFO the earlier jobs go first. The first error is raised.
    """

    def pooled(number: int, item):
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"candidate-{number % parallel}")
        try:
            return run(item)
        finally:
            spark.sparkContext.setLocalProperty("spark.scheduler.pool", None)

    with ThreadPoolExecutor(max_workers=parallel) as pool:
        started = [pool.submit(inheritable_thread_target(spark)(pooled), i, item) for i, item in enumerate(items)]
        return [s.result() for s in started]


def sweep(
    rows: DataFrame,
    features: Sequence[str],
    candidates: Iterable[tuple[str, Mapping]],
    *,
    seed: int = 42,
    patience: int = PATIENCE,
    parallel: int = PARALLEL,
) -> DataFrame:
    """Validation error per candidate setting: (name, val_mse), in the order of the candidates.

    The loop runs over candidates, not data; each fit is distributed, and ``parallel`` of them are in flight.
    """

    def run(candidate: tuple[str, Mapping]) -> DataFrame:
        name, params = candidate
        model = fit_boosted_trees(rows, features, params=params, seed=seed, patience=patience)
        return stored(validation_error(model, rows).select(F.lit(name).alias("name"), F.col("mse").alias("val_mse")), "errors")

    results = side_by_side(rows.sparkSession, run, candidates, parallel)
    if not results:
        raise ValueError("no candidates")
    return reduce(DataFrame.unionByName, results)


@dataclass(frozen=True)
class Candidate:
    """Settings to try: learner parameters, and the features (such as a set of lookbacks) to use."""

    name: str
    features: Sequence[str]
    params: Mapping = field(default_factory=dict)


def candidate_runs(
    panel: DataFrame,
    target: str,
    candidates: Sequence[Candidate],
    end_dates: Sequence[date],
    *,
    fold_sizes: Mapping[str, int],
    purge: int = 0,
    embargo: int = 0,
    rules: portfolio.PortfolioRules = portfolio.PortfolioRules(),
    limits: Mapping[str, float | None] | None = None,
    seed: int = 42,
    patience: int = PATIENCE,
    block: int = BLOCK,
    parallel: int = PARALLEL,
) -> DataFrame:
    """One row per (end_date, name): test rows, rank IC, IC, portfolio figures, score and gate.

    Each candidate is trained and scored on the last fold that ends by each end
    date, as if later rows did not exist yet. ``panel`` (features and target) is
    read often and should be a stored table. The rows feed ``sweep.best_reruns``,
    ``summarize_runs``, ``best_candidate`` and ``best_run``. The loop runs
    over settings, not data, ``parallel`` of them side by side; rows come in the order of dates and candidates. A period with too few days gives an error.
    """
    cuts = []
    for end in end_dates:
        known = panel.filter(F.col("decision_date") <= F.lit(end))
        cut = folds.purge_and_embargo(
            folds.walk_forward(folds.trading_days(known), **fold_sizes),
            train=fold_sizes["train"], val=fold_sizes["val"], purge=purge, embargo=embargo,
        )
        fold = stored(folds.last_fold(cut), "fold")
        if fold.isEmpty():
            raise ValueError(f"not enough days for a fold by {end}")
        cuts.append((end, known, fold))

    def run(task: tuple) -> DataFrame:
        (end, known, fold), c = task
        rows = stored(training_rows(known, fold, c.features, target), "training")
        model = fit_boosted_trees(rows, c.features, params=c.params, seed=seed, patience=patience, block=block)
        test = stored(score(model, known, fold, c.features, target, c.name).filter("split = 'test'"), "scores")
        daily, _ = portfolio.run_portfolio(test, rules)
        quality = evaluate_predictions(test).groupBy("model_name").agg(
            F.max(F.when(F.col("kind") == "rank_ic", F.col("mean"))).alias("rank_ic"),
            F.max(F.when(F.col("kind") == "ic", F.col("mean"))).alias("ic_test_mean"),
        )
        counted = test.groupBy("model_name").agg(F.count(F.lit(1)).alias("test_rows"))
        figures = portfolio.portfolio_summary(daily).withColumn("model_name", F.lit(c.name))
        row = counted.join(quality, "model_name", "left").join(figures, "model_name", "left")
        return stored(row.withColumnRenamed("model_name", "name").withColumn("end_date", F.lit(end)), "run")

    results = side_by_side(panel.sparkSession, run, [(cut, c) for cut in cuts for c in candidates], parallel)
    if not results:
        raise ValueError("no candidates or no end dates")
    runs = reduce(DataFrame.unionByName, results)
    gated = run_gate(runs.withColumn("score", candidate_score()), **({} if limits is None else {"limits": limits}))
    return gated.withColumns({"ops_gate_ok": F.col("gate_ok"), "rank_ic_test_mean": F.col("rank_ic")})
