import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F

from panelkiln.operators import folds, metrics, models, sweep
from panelkiln.session import fresh_folder
from tests.helpers import weekdays

RUNS = (
    "end_date string, name string, seq int, score double, ops_gate_ok boolean, rank_ic_test_mean double, sharpe double,"
    " total_return double, max_drawdown double"
)


def test_reruns_summary_and_ranking(spark):
    nan = float("nan")
    rows = [
        ("d1", "a", 1, nan, True, 0.1, 1.0, 0.1, -0.1),
        ("d1", "a", 2, 3.0, True, 0.2, 2.0, 0.2, -0.2),
        ("d1", "a", 3, 3.0, False, 0.3, 3.0, 0.3, -0.3),
        ("d2", "a", 4, 1.0, True, 0.4, 4.0, 0.4, None),
        ("d1", "b", 5, 9.0, None, 0.5, 5.0, 0.5, -0.5),
        ("d2", "b", 6, nan, True, None, 6.0, 0.6, -0.6),
        ("d1", "c", 7, 50.0, True, 0.7, 7.0, 0.7, -0.7),
    ]
    best = sweep.best_reruns(spark.createDataFrame(rows, RUNS), "seq")
    assert {r["seq"] for r in best.collect()} == {2, 4, 5, 6, 7}
    summary = sweep.summarize_runs(best.withColumn("lookbacks", F.array("seq")), "seq", settings=("lookbacks",))
    got = {r["name"]: r for r in summary.collect()}
    assert (got["a"]["periods"], got["a"]["gate_pass_periods"], got["a"]["all_periods_gate_pass"]) == (2, 2, True)
    assert (got["a"]["score_mean"], got["a"]["score_min"], got["a"]["lookbacks"]) == (2.0, 1.0, [2])
    assert (got["b"]["score_min"], got["b"]["all_periods_gate_pass"], got["b"]["rank_ic_mean"]) == (9.0, False, 0.5)
    # One period of two does not count as passing them all.
    assert got["c"]["all_periods_gate_pass"] is False
    assert sweep.best_candidate(summary).first()["name"] == "a"


def test_score_penalises_missing_figures(spark):
    schema = "rank_ic double, sharpe double, total_return double, max_drawdown double"
    df = spark.createDataFrame([(0.1, 2.0, 1.0, -0.5), (None, None, None, None)], schema)
    got = [r[0] for r in df.select(sweep.candidate_score()).collect()]
    assert got[0] == pytest.approx(12 + 2.4 + 0.05 - 2)
    assert got[1] == pytest.approx(-120 - 12 - 0.5 - 4)


def test_run_gate(spark):
    schema = "name string, sharpe double, total_return double, max_drawdown double, avg_cost double, score double"
    df = spark.createDataFrame([("good", 1.0, 0.1, -0.1, 0.01, 1.0), ("bad", 0.1, None, -0.9, 0.5, 9.0)], schema)
    got = {r["name"]: r for r in sweep.run_gate(df).collect()}
    assert got["good"]["gate_ok"] and got["good"]["violations"] == []
    assert len(got["bad"]["violations"]) == 4 and "value=none" in got["bad"]["violations"][1]
    assert sweep.best_run(sweep.run_gate(df)).first()["name"] == "good"
    assert sweep.best_run(sweep.run_gate(df).filter("name = 'bad'")).first()["name"] == "bad"
    lenient = sweep.run_gate(df, {"min_sharpe": 0.0, "max_avg_cost": None})
    assert all(r["gate_ok"] for r in lenient.collect())
    assert all(r["gate_ok"] for r in sweep.run_gate(df, {}).collect())


def test_distinct_candidates(spark):
    rows = [(1, "a", [1, 5], 1), (2, "b", [1, 5], None), (3, "c", [5, 1], 1), (4, "d", [1, 5], 2)]
    df = spark.createDataFrame(rows, "seq int, name string, lookbacks array<int>, event_shift int")
    assert {r["name"] for r in sweep.distinct_candidates(df, "seq").collect()} == {"a", "c", "d"}


@pytest.fixture(scope="module")
def fitted(spark):
    days = weekdays("2023-01-02", 100)
    rows = []
    for i, day in enumerate(days):
        for s in range(20):
            x = ((i * 31 + s * 17) % 101) / 100.0
            z = float("inf") if (i + s) % 50 == 0 else ((i * 7 + s) % 13) / 13.0
            rows.append((day, f"S{s}", x, z, 2.0 * x - 1.0, 0.02))
    panel = spark.createDataFrame(rows, "decision_date date, symbol string, x double, z double, y double, vol_20d double").cache()
    fold = folds.walk_forward(folds.trading_days(panel), train=60, val=20, test=20, step=20)
    return panel, fold, models.training_rows(panel, fold, ["x", "z"], "y").cache()


def test_training_rows_are_finite(fitted):
    _, _, rows = fitted
    infinite = sum((i + s) % 50 == 0 for i in range(80) for s in range(20))
    assert rows.count() == 80 * 20 - infinite
    assert {r["is_val"] for r in rows.select("is_val").distinct().collect()} == {True, False}


def test_trees_beat_the_mean_and_survive_saving(spark, fitted):
    panel, fold, rows = fitted
    model = models.fit_boosted_trees(rows, ["x", "z"], params={"maxIter": 10, "maxDepth": 3})
    mean = rows.filter("NOT is_val").agg(F.avg("y_true")).first()[0]
    flat = metrics.mean_squared_error(rows.filter("is_val").withColumn("y_pred", F.lit(mean))).first()[0]
    assert models.validation_error(model, rows).first()[0] < flat
    path = fresh_folder(spark, "t-model")
    models.save(model, path)
    a = models.score(model, panel, fold, ["x", "z"], "y", "trees")
    b = models.score(models.load(path), panel, fold, ["x", "z"], "y", "trees")
    # Infinite inputs are kept out of training only.
    assert a.count() == 2000 and a.columns[-1] == "vol_20d"
    assert a.agg(F.sum("y_pred")).first() == b.agg(F.sum("y_pred")).first()


def test_small_targets_get_more_than_one_tree_and_the_best_is_kept(fitted):
    _, _, rows = fitted
    small = rows.withColumn("y_true", F.col("y_true") / 100).cache()
    model = models.fit_boosted_trees(small, ["x"], params={"maxIter": 12, "maxDepth": 3, "stepSize": 0.3}, patience=3, block=4)
    assert model.stages[-1].getNumTrees > 1
    noise = small.withColumn("y_true", F.when(F.col("is_val"), -F.col("y_true")).otherwise(F.col("y_true"))).cache()
    model = models.fit_boosted_trees(noise, ["x"], params={"maxIter": 12, "maxDepth": 3}, patience=3, block=4)
    assert model.stages[-1].getNumTrees == 1


def test_blocks_give_the_trees_of_one_fit(fitted):
    """However the trees are blocked, and no worse than Spark's own boosting of as many trees."""
    _, _, rows = fitted
    params = {"maxIter": 9, "maxDepth": 3, "subsamplingRate": 1.0, "featureSubsetStrategy": "all", "stepSize": 0.3}
    errors = [models.validation_error(models.fit_boosted_trees(rows, ["x", "z"], params=params, block=b), rows).first()[0] for b in (1, 4, 20)]
    assert max(errors) - min(errors) < 1e-12
    data = VectorAssembler(inputCols=["x", "z"], outputCol="inputs").transform(rows)
    own = GBTRegressor(featuresCol="inputs", labelCol="y_true", predictionCol="y_pred", maxIter=9, maxDepth=3, stepSize=0.3, minInstancesPerNode=20, seed=42)
    trees = own.fit(data.where("NOT is_val"))
    least = min(trees.evaluateEachIteration(data.where("is_val"), "squared"))
    assert errors[0] <= 1.01 * least


def test_each_tree_is_fitted_once(fitted, monkeypatch):
    _, _, rows = fitted
    fits = []
    fit = models.RandomForestRegressor.fit
    monkeypatch.setattr(models.RandomForestRegressor, "fit", lambda self, data: fits.append(1) or fit(self, data))
    noise = rows.withColumn("y_true", F.when(F.col("is_val"), -F.col("y_true")).otherwise(F.col("y_true")))
    model = models.fit_boosted_trees(noise, ["x"], params={"maxIter": 40, "maxDepth": 2}, patience=5, block=3)
    assert len(fits) == 6 and model.stages[-1].getNumTrees == 1
    fits.clear()
    model = models.fit_boosted_trees(rows.where("NOT is_val"), ["x"], params={"maxIter": 5, "maxDepth": 2}, patience=1, block=2)
    assert len(fits) == 5 == model.stages[-1].getNumTrees


def test_side_by_side_keeps_the_order_and_raises(spark):
    import threading
    import time

    seen = []

    def run(i):
        seen.append((threading.get_ident(), spark.sparkContext.getLocalProperty("spark.scheduler.pool")))
        time.sleep(0.3 - i / 20)
        if i == 5:
            raise ValueError("five")
        return spark.range(i).count()

    assert models.side_by_side(spark, run, range(5), 4) == list(range(5))
    assert len({t for t, _ in seen}) > 1 and {p for _, p in seen} == {f"candidate-{i}" for i in range(4)}
    with pytest.raises(ValueError, match="five"):
        models.side_by_side(spark, run, range(6), 3)


def test_candidates_over_end_dates_feed_the_summary(fitted):
    panel, _, _ = fitted
    days = sorted(r[0] for r in panel.select("decision_date").distinct().collect())
    candidates = [models.Candidate("x", ["x"], {"maxIter": 4, "maxDepth": 2}), models.Candidate("z", ["z"], {"maxIter": 2, "maxDepth": 1})]
    sizes = {"train": 40, "val": 15, "test": 15, "step": 5}
    runs = models.candidate_runs(
        panel, "y", candidates, [days[80], days[99]], fold_sizes=sizes, patience=2, block=4, limits={"min_sharpe": None, "min_total_return": 0.0}
    ).cache()
    got = {(r["end_date"], r["name"]): r for r in runs.collect()}
    assert set(got) == {(d, n) for d in (days[80], days[99]) for n in "xz"}
    # The outcome is a line in x and has nothing to do with z.
    for d in (days[80], days[99]):
        assert got[d, "x"]["test_rows"] == 15 * 20 and got[d, "x"]["rank_ic"] > 0.8 > got[d, "z"]["rank_ic"]
    summary = sweep.summarize_runs(runs.withColumn("seq", F.monotonically_increasing_id()), "seq")
    assert sweep.best_candidate(summary).first()["name"] == "x"
    with pytest.raises(ValueError, match="not enough days"):
        models.candidate_runs(panel, "y", candidates, [days[5]], fold_sizes=sizes)


def test_linear_fit_recovers_the_line(fitted):
    panel, fold, rows = fitted
    model = models.fit_linear(rows, ["x"])
    worst = models.score(model, panel, fold, ["x"], "y", "linear").agg(F.max(F.abs(F.col("y_pred") - F.col("y_true")))).first()[0]
    assert worst < 1e-9


def test_sweep_returns_a_row_per_candidate(fitted):
    _, _, rows = fitted
    got = models.sweep(rows, ["x"], [("shallow", {"maxIter": 2, "maxDepth": 1}), ("deep", {"maxIter": 5, "maxDepth": 4})])
    errors = {r["name"]: r["val_mse"] for r in got.collect()}
    assert errors["deep"] < errors["shallow"]
    with pytest.raises(ValueError):
        models.sweep(rows, ["x"], [])
