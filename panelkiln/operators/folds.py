"""Walk-forward folds over the trading days, with purge and embargo.

Everything here works on distinct days, a table bounded by the calendar. That
is why one ordered window over all of it is fine.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from panelkiln.operators.rows import attach_daily


def trading_days(panel: DataFrame, on: str = "decision_date") -> DataFrame:
    """Distinct days with their 0-based position."""
    days = panel.select(F.col(on).alias("date")).dropna().distinct()
    return days.withColumn("pos", F.row_number().over(Window.orderBy("date")) - 1)


def walk_forward(days: DataFrame, *, train: int, val: int, test: int, step: int) -> DataFrame:
    """(fold, part, date, part_pos): windows that start every ``step`` days; only full folds."""
    if min(train, val, test, step) <= 0:
        raise ValueError("train, val, test and step must be positive")
    span = train + val + test
    total = F.count(F.lit(1)).over(Window.partitionBy())
    n_folds = F.greatest(F.floor((total - span) / F.lit(step)) + 1, F.lit(0))
    # Fold f covers positions [f*step, f*step + span): solve for the folds of a position.
    first = F.greatest(F.ceil((F.col("pos") - span + 1) / F.lit(step)), F.lit(0))
    last = F.least(F.floor(F.col("pos") / F.lit(step)), n_folds - 1)
    offset = F.col("pos") - F.col("fold") * step
    part = F.when(offset < train, "train").when(offset < train + val, "val").otherwise("test")
    part_pos = (
        F.when(offset < train, offset).when(offset < train + val, offset - train).otherwise(offset - train - val)
    )
    return (
        days.withColumn("_folds", F.when(first <= last, F.sequence(first, last)))
        .select("date", "pos", F.explode("_folds").alias("fold"))
        .select(F.col("fold").cast("int"), part.alias("part"), "date", part_pos.cast("int").alias("part_pos"))
    )


def purge_and_embargo(folds: DataFrame, *, train: int, val: int, purge: int, embargo: int) -> DataFrame:
    """Train loses its last ``purge`` days, test its first ``embargo``, val both."""
    purge, embargo = max(0, purge), max(0, embargo)
    pos = F.col("part_pos")
    keep = (
        ((F.col("part") == "train") & (pos < train - purge))
        | ((F.col("part") == "val") & (pos >= embargo) & (pos < val - purge))
        | ((F.col("part") == "test") & (pos >= embargo))
    )
    return folds.filter(keep)


def fold_windows(folds: DataFrame) -> DataFrame:
    """First and last day of each part of each fold."""
    return folds.groupBy("fold", "part").agg(
        F.min("date").alias("start"), F.max("date").alias("end"), F.count(F.lit(1)).alias("days")
    )


def fold_order(folds: DataFrame) -> DataFrame:
    """Per fold: whether its parts are all there and train ends before val, val before test."""

    def edge(agg, part):
        return agg(F.when(F.col("part") == part, F.col("date")))

    ordered = (edge(F.max, "train") < edge(F.min, "val")) & (edge(F.max, "val") < edge(F.min, "test"))
    return folds.groupBy("fold").agg(F.coalesce(ordered, F.lit(False)).alias("ok"))


def last_fold(folds: DataFrame) -> DataFrame:
    return folds.filter(F.col("fold") == folds.agg(F.max("fold")).scalar())


def in_part(panel: DataFrame, fold: DataFrame, part: str, on: str = "decision_date") -> DataFrame:
    """Panel rows whose day belongs to one part of a single fold."""
    days = fold.filter(F.col("part") == part).select(F.col("date").alias(on))
    return attach_daily(panel, days, on, "left_semi")


def tag_parts(panel: DataFrame, fold: DataFrame, on: str = "decision_date") -> DataFrame:
    """Panel rows of a single fold with their part as ``split``; days outside it drop out."""
    days = fold.select(F.col("date").alias(on), F.col("part").alias("split"))
    return attach_daily(panel, days, on, "inner")
