"""Queries that fit and apply models."""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import functions as F

from panelkiln.operators import folds, metrics, models, portfolio
from panelkiln.plans import sql_parts as s
from panelkiln.plans.portfolio_queries import LAST_FOLD_SQL, SIZES, merged_panel, purged_folds
from panelkiln.plans.registry import query, rounded
from panelkiln.session import fresh_folder, stored

FEATURES = ["ret_1d", "ret_5d", "vol_20d", "range_20d", "volume_z_20d"]
TARGET = "log_return"
TREES = {"maxIter": 24, "maxDepth": 3}
PATIENCE = 8
BLOCK = 6

#: The last fold's panel rows that have all inputs, and those among them that have a finite target.
PANEL_SQL = f"""{LAST_FOLD_SQL}, {s.BARS}, {s.features([1, 5])}, {s.labels(5)},
    joined AS (SELECT *, ln(1 + future_return_5d) AS y FROM feats JOIN labels_h USING (decision_date, symbol) JOIN fold1 ON date = decision_date),
    scored AS (SELECT * FROM joined WHERE ret_1d IS NOT NULL AND ret_5d IS NOT NULL AND vol_20d IS NOT NULL AND range_20d IS NOT NULL AND volume_z_20d IS NOT NULL),
    fitted AS (SELECT * FROM scored WHERE y IS NOT NULL AND isfinite(y))"""


def model_panel(spark, sf_dir):
    """Features with the log of the next 5-row return as target, stored for repeated passes."""
    merged = merged_panel(spark, sf_dir).withColumn(TARGET, F.log1p("future_return_5d"))
    return stored(merged.select("decision_date", "symbol", *FEATURES, "adv20_dollar", TARGET), "model-panel")


def _last_fold(spark, sf_dir):
    return stored(folds.last_fold(purged_folds(spark, sf_dir)), "fold")


@query(
    "m01_a26_boosted_trees",
    f"""WITH {PANEL_SQL}, m AS (SELECT avg(y) AS mean FROM fitted WHERE part = 'train')
    SELECT (SELECT count(*) FROM fitted WHERE part = 'train') AS train_rows, count(*) AS val_rows, round(avg((y - mean) ** 2), 6) + 0.0 AS mean_mse,
      true AS ends_at_best FROM fitted, m WHERE part = 'val'""",
)
def _boosted_trees(spark, sf_dir):
    """Rows, validation error of the training mean, and whether the model ends with the tree of least validation error.

    The test prices are independent draws, so nothing need beat the mean here; tests/ has a panel where trees do.
    """
    panel, fold = model_panel(spark, sf_dir), _last_fold(spark, sf_dir)
    rows = stored(models.training_rows(panel, fold, FEATURES, TARGET), "training")
    model = models.fit_boosted_trees(rows, FEATURES, params=TREES, patience=PATIENCE, block=BLOCK)
    mean = rows.filter("NOT is_val").agg(F.avg("y_true")).scalar()
    baseline = metrics.mean_squared_error(rows.filter("is_val").withColumn("y_pred", mean))
    counts = rows.agg(F.count_if(~F.col("is_val")).alias("train_rows"), F.count_if("is_val").alias("val_rows"))
    inputs, trees = model.stages
    errors = trees.evaluateEachIteration(inputs.transform(rows.filter("is_val")), "squared")
    best = F.lit(errors.index(min(errors)) + 1 == trees.getNumTrees)
    return rounded(counts.select("*", baseline.scalar().alias("mean_mse"), best.alias("ends_at_best")))


LINEAR_SQL = f"""{LAST_FOLD_SQL.replace("fold1 AS (", "fold1 AS MATERIALIZED (")}, {s.BARS}, {s.features([1, 5])}, {s.labels(5)},
    panel AS MATERIALIZED (SELECT decision_date, symbol, ret_5d, ln(1 + future_return_5d) AS y, part FROM feats JOIN labels_h USING (decision_date, symbol)
      JOIN fold1 ON date = decision_date WHERE ret_5d IS NOT NULL),
    fit AS MATERIALIZED (SELECT regr_slope(y, ret_5d) AS b, regr_intercept(y, ret_5d) AS c, count(*) AS n FROM panel WHERE part = 'train')"""


@query("m02_linear_coefficients", f"WITH {LINEAR_SQL} SELECT n AS train_rows, round(b, 6) + 0.0 AS slope, round(c, 6) + 0.0 AS intercept FROM fit")
def _linear_coefficients(spark, sf_dir):
    """The line that training rows give, by itself."""
    panel, fold = model_panel(spark, sf_dir), _last_fold(spark, sf_dir)
    rows = stored(models.training_rows(panel, fold, ["ret_5d"], TARGET), "training")
    line = models.fit_linear(rows, ["ret_5d"]).stages[-1]
    counts = rows.agg(F.count_if(~F.col("is_val")).alias("train_rows"))
    return rounded(counts.withColumns({"slope": F.lit(float(line.coefficients[0])), "intercept": F.lit(float(line.intercept))}))


@query(
    "m02_m03_linear_scores",
    f"""WITH {LINEAR_SQL}
    SELECT 'linear' AS model_name, part AS split, decision_date, symbol, round(y, 6) + 0.0 AS y_true,
      round((SELECT c FROM fit) + (SELECT b FROM fit) * ret_5d, 6) + 0.0 AS y_pred FROM panel""",
)
def _linear_scores(spark, sf_dir):
    panel, fold = model_panel(spark, sf_dir), _last_fold(spark, sf_dir)
    model = models.fit_linear(models.training_rows(panel, fold, ["ret_5d"], TARGET), ["ret_5d"])
    scored = models.score(model, panel, fold, ["ret_5d"], TARGET, "linear")
    return rounded(scored.select("model_name", "split", "decision_date", "symbol", "y_true", "y_pred"))


@query(
    "m04_saved_model_scores",
    f"WITH {PANEL_SQL} SELECT 'boosted_trees' AS model_name, part AS split, count(*) AS n, CAST(0 AS DOUBLE) AS max_difference FROM scored GROUP BY part",
)
def _saved_model_scores(spark, sf_dir):
    """Scores per split from a model that was saved and loaded again, held against those of the model in memory."""
    panel, fold = model_panel(spark, sf_dir), _last_fold(spark, sf_dir)
    rows = stored(models.training_rows(panel, fold, FEATURES, TARGET), "training")
    path = fresh_folder(spark, "model")
    model = models.fit_boosted_trees(rows, FEATURES, params=TREES, patience=PATIENCE, block=BLOCK)
    models.save(model, path)
    before = models.score(model, panel, fold, FEATURES, TARGET, "boosted_trees")
    after = models.score(models.load(path), panel, fold, FEATURES, TARGET, "boosted_trees")
    both = after.join(before.select(*models.KEY, F.col("y_pred").alias("y_memory")), models.KEY)
    difference = F.max(F.abs(F.col("y_pred") - F.col("y_memory"))).alias("max_difference")
    return rounded(both.groupBy("model_name", "split").agg(F.count("y_pred").alias("n"), difference))


END_DATES = (date(1998, 6, 30), date(2000, 12, 31))
CANDIDATES = [
    models.Candidate("one_day", ("ret_1d", "vol_20d"), {"maxIter": 4, "maxDepth": 2}),
    models.Candidate("five_days", ("ret_1d", "ret_5d", "vol_20d"), {"maxIter": 4, "maxDepth": 3}),
]


@query(
    "m05_candidate_sweep",
    f"""WITH {s.BARS}, {s.features([1, 5])}, {s.labels(5)},
    panel AS (SELECT * FROM feats JOIN labels_h USING (decision_date, symbol)),
    ends AS (SELECT unnest([{", ".join(f"DATE '{d}'" for d in END_DATES)}]) AS end_date),
    days AS (SELECT end_date, decision_date, row_number() OVER (PARTITION BY end_date ORDER BY decision_date) - 1 AS pos, count(*) OVER (PARTITION BY end_date) AS n
      FROM (SELECT DISTINCT end_date, decision_date FROM panel, ends WHERE decision_date <= end_date)),
    test AS (SELECT end_date, decision_date FROM days WHERE pos - (n - 756) // 63 * 63 BETWEEN 635 AND 755),
    rows AS (SELECT * FROM panel JOIN test USING (decision_date) WHERE ret_1d IS NOT NULL AND vol_20d IS NOT NULL)
    SELECT end_date, 'one_day' AS name, count(*) AS test_rows, true AS has_figures FROM rows GROUP BY end_date
    UNION ALL SELECT end_date, 'five_days', count(*), true FROM rows WHERE ret_5d IS NOT NULL GROUP BY end_date""",
)
def _candidate_sweep(spark, sf_dir):
    """M5: candidates x end dates. The figures depend on the learner; that they are there is checked."""
    panel = model_panel(spark, sf_dir)
    runs = models.candidate_runs(
        panel, TARGET, CANDIDATES, END_DATES, fold_sizes={**SIZES, "step": 63}, purge=20, embargo=5,
        rules=portfolio.PortfolioRules(topn=3, max_names=3), patience=2, block=2,
    )
    present = [F.col(c).isNotNull() for c in ("rank_ic", "sharpe", "total_return", "max_drawdown", "score", "gate_ok")]
    return runs.select("end_date", "name", "test_rows", reduce(lambda x, y: x & y, present).alias("has_figures"))
