"""Candidate sweeps: reruns merged, periods summarised, gates applied, winners ranked."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from panelkiln.functions.numeric import number, truthy
from panelkiln.operators.rows import keep_first, keep_last

# Score weights for (rank IC, Sharpe, total return, max drawdown),
# and what a missing figure counts as.
STABILITY_WEIGHTS = (120.0, 1.2, 0.05, 4.0)
MODEL_SMOKE_WEIGHTS = (100.0, 0.5, 10.0, 2.0)
FEATURE_SMOKE_WEIGHTS = (100.0, 0.2, 0.001, 0.0)
MISSING_FIGURES = (-1.0, -10.0, -10.0, -1.0)
FIGURES = ("rank_ic", "sharpe", "total_return", "max_drawdown")

# Default limits of the run gate.
GATE_LIMITS = {"min_sharpe": 0.5, "min_total_return": -0.25, "min_max_drawdown": -0.45, "max_avg_cost": 0.03}


def candidate_score(
    weights: tuple[float, ...] = STABILITY_WEIGHTS, missing: tuple[float, ...] = MISSING_FIGURES
) -> Column:
    """Weighted sum of the run figures; a missing figure counts as its penalty."""
    terms = [
        F.coalesce(number(name), F.lit(penalty)) * F.lit(weight)
        for name, weight, penalty in zip(FIGURES, weights, missing)
    ]
    return sum(terms[1:], terms[0])


def run_gate(runs: DataFrame, limits: Mapping[str, float | None] = GATE_LIMITS) -> DataFrame:
    """Runs with ``gate_ok`` and ``violations``. A missing figure fails; a missing limit passes."""
    rules = (
        ("min_sharpe", "sharpe", ">="),
        ("min_total_return", "total_return", ">="),
        ("min_max_drawdown", "max_drawdown", ">="),
        ("max_avg_cost", "avg_cost", "<="),
    )
    found = []
    for limit_name, figure, relation in rules:
        limit = limits.get(limit_name)
        if limit is None:
            continue
        value = number(figure)
        holds = truthy(value >= limit if relation == ">=" else value <= limit)
        shown = F.when(value.isNull(), "none").otherwise(F.format_string("%.9f", value))
        text = F.concat(F.lit(f"{limit_name} value="), shown, F.lit(f" required{relation}{float(limit)}"))
        found.append(F.when(~holds, text))
    if not found:
        found = [F.lit(None).cast("string")]
    violations = F.filter(F.array(*found), lambda v: v.isNotNull())
    return runs.withColumn("violations", violations).withColumn("gate_ok", F.size("violations") == 0)


def best_reruns(runs: DataFrame, order: str) -> DataFrame:
    """One run per (end_date, name): the best scored; on a tie, or without scores, the earliest."""
    typed = runs.withColumn("score", number("score"))
    return keep_last(typed, ["end_date", "name"], [F.col("score"), -F.col(order)])


def summarize_runs(runs: DataFrame, order: str, settings: tuple[str, ...] = ()) -> DataFrame:
    """Per candidate: periods, gate passes, mean and worst score, mean figures, settings of its first run."""
    periods_in_all = runs.agg(F.count_distinct("end_date")).scalar()
    score = number("score")
    gate = truthy(F.col("ops_gate_ok"))
    return (
        runs.groupBy("name")
        .agg(
            F.count(F.lit(1)).alias("periods"),
            F.count_if(gate).alias("gate_pass_periods"),
            F.avg(score).alias("score_mean"),
            F.min(score).alias("score_min"),
            F.avg(number("rank_ic_test_mean")).alias("rank_ic_mean"),
            F.avg(number("sharpe")).alias("sharpe_mean"),
            F.avg(number("total_return")).alias("total_return_mean"),
            F.avg(number("max_drawdown")).alias("max_drawdown_mean"),
            *[F.min_by(c, order).alias(c) for c in settings],
        )
        .withColumn(
            "all_periods_gate_pass",
            (F.col("gate_pass_periods") == F.col("periods")) & (F.col("periods") == periods_in_all),
        )
    )


def summary_order() -> list[Column]:
    return [
        F.col("all_periods_gate_pass").desc(),
        F.col("score_mean").desc_nulls_last(),
        F.col("score_min").desc_nulls_last(),
        F.col("name"),
    ]


def best_candidate(summary: DataFrame) -> DataFrame:
    """The single best summarised candidate."""
    return summary.orderBy(*summary_order()).limit(1)


def best_run(runs: DataFrame, tie: str = "name") -> DataFrame:
    """The best scored run that passes the gate, or the best scored of all if none does."""
    order = [truthy(F.col("gate_ok")).desc(), number("score").desc_nulls_last(), F.col(tie)]
    return runs.orderBy(*order).limit(1)


def distinct_candidates(candidates: DataFrame, order: str) -> DataFrame:
    """Candidates with the same lookbacks and event shift once, the first kept; no shift means 1."""
    typed = candidates.withColumn("event_shift", F.coalesce("event_shift", F.lit(1)))
    return keep_first(typed, ["lookbacks", "event_shift"], [F.col(order)])
