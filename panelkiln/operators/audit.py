"""Leakage audits: dates in order, no shared days, no feature that gives the target away."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from panelkiln.functions.frames import correlation
from panelkiln.functions.numeric import number, truthy
from panelkiln.operators.folds import fold_order, in_part

MIN_PAIRS = 50

# The messages of the audits below are fixed values.


def label_audit(labels: DataFrame) -> DataFrame:
    """One row (ok, bad_rows, message): every label lies after its decision."""
    bad = F.count_if(truthy(F.col("label_date") <= F.col("decision_date")))
    return _audit(labels, bad, "labels_empty", "label_date_not_after_decision_date")


def feature_audit(features: DataFrame) -> DataFrame:
    """One row (ok, bad_rows, message): every feature was known before its decision."""
    if "feature_available_date" not in features.columns:
        return features.agg(
            F.lit(False).alias("ok"), F.lit(0).cast("long").alias("bad_rows"),
            F.lit("missing_feature_available_date").alias("message"),
        )
    late = F.col("feature_available_date").isNull() | (F.col("feature_available_date") >= F.col("decision_date"))
    return _audit(
        features, F.count_if(late), "features_empty", "feature_available_date_not_before_decision_date"
    )


def _audit(df: DataFrame, bad, when_empty: str, when_bad: str) -> DataFrame:
    row = df.agg(F.count(F.lit(1)).alias("rows"), bad.alias("bad_rows"))
    message = (
        F.when(F.col("rows") == 0, F.lit(when_empty))
        .when(F.col("bad_rows") > 0, F.concat(F.lit(f"{when_bad} rows="), F.col("bad_rows").cast("string")))
        .otherwise(F.lit(""))
    )
    return row.select((message == "").alias("ok"), "bad_rows", message.alias("message"))


def shared_days(fold: DataFrame) -> DataFrame:
    """One row: number of days in both train and test."""
    train = fold.filter(F.col("part") == "train").select("date")
    test = fold.filter(F.col("part") == "test").select("date")
    return train.intersect(test).agg(F.count(F.lit(1)).alias("overlap"))


def feature_correlations(merged: DataFrame, features: Sequence[str], target: str) -> DataFrame:
    """(feature, pairs, corr) in one pass over the table: a fixed set of sums per feature."""
    typed = merged.select(number(target).alias("_y"), *[number(c).alias(c) for c in features])
    y = F.col("_y")
    moments = typed.agg(
        *[
            F.struct(
                F.lit(c).alias("feature"),
                F.count_if(F.col(c).isNotNull() & y.isNotNull()).alias("pairs"),
                correlation(F.col(c), y).alias("corr"),
            ).alias(f"_{i}")
            for i, c in enumerate(features)
        ]
    )
    return moments.select(F.explode(F.array(*moments.columns)).alias("f")).select("f.*")


def suspicious_features(
    merged: DataFrame, features: Sequence[str], target: str, *, threshold: float = 0.995
) -> DataFrame:
    """Features correlated with the target at or above ``threshold`` on enough pairs."""
    return feature_correlations(merged, features, target).filter(
        (F.col("pairs") >= MIN_PAIRS) & ~F.isnan("corr") & (F.abs("corr") >= threshold)
    )


def leakage_gate(
    *,
    features: DataFrame,
    labels: DataFrame,
    merged: DataFrame,
    fold: DataFrame,
    feature_names: Sequence[str],
    target: str,
    threshold: float = 0.995,
) -> DataFrame:
    """One row: ``passed``, the map of critical checks, messages, suspicious features."""
    train = in_part(merged, fold, "train")
    hits = suspicious_features(train, feature_names, target, threshold=threshold)
    checks = [
        _check("split_no_overlap", fold_order(fold).agg(F.coalesce(F.bool_and("ok"), F.lit(False)).alias("ok"))),
        _check(
            "train_test_date_overlap_zero",
            shared_days(fold).select(
                (F.col("overlap") == 0).alias("ok"),
                F.when(F.col("overlap") > 0, F.format_string("train_test_date_overlap=%d", F.col("overlap"))).alias(
                    "message"
                ),
            ),
        ),
        _check("feature_audit", feature_audit(features)),
        _check("label_audit", label_audit(labels)),
        _check(
            "corr_threshold_pass",
            # One entry per feature name, so the list is as short as the column list.
            hits.agg(
                F.array_sort(F.collect_list(F.format_string("%s:corr=%.4f", "feature", "corr"))).alias("names")
            ).select(
                (F.size("names") == 0).alias("ok"),
                F.when(
                    F.size("names") > 0,
                    F.concat(F.lit("suspicious_feature_corr: "), F.array_join("names", ", ")),
                ).alias("message"),
                "names",
            ),
        ),
    ]
    table = checks[0]
    for check in checks[1:]:
        table = table.unionByName(check)
    # Five rows from here on.
    return table.agg(
        F.bool_and("ok").alias("passed"),
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("name", "ok")))).alias("critical"),
        F.array_sort(F.collect_list(F.when(F.col("message") != "", F.col("message")))).alias("messages"),
        F.flatten(F.collect_list("names")).alias("suspicious"),
    )


def _check(name: str, row: DataFrame) -> DataFrame:
    message = F.col("message") if "message" in row.columns else F.lit("")
    names = F.col("names") if "names" in row.columns else F.array().cast("array<string>")
    return row.select(F.lit(name).alias("name"), "ok", message.alias("message"), names.alias("names"))
