"""Merging new rows into stored tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from panelkiln.functions.dates import add_business_days
from panelkiln.functions.digests import set_digest, sha1_prefix
from panelkiln.operators.rows import keep_first, keep_last, stack
from panelkiln.session import fresh_folder
from panelkiln.sources.tables import optional_table, with_month, write_table

KEY = ("date", "symbol")


def _ranks(df: DataFrame, order: Sequence[str]) -> list[str]:
    """Arrival first; rows that arrived together are told apart by their values."""
    return [*order, *(c for c in df.columns if c not in order)]


def existing_wins(
    existing: DataFrame, new: DataFrame, keys: Sequence[str] = KEY, order: Sequence[str] = ()
) -> DataFrame:
    """Existing rows, plus the first new row under each key not yet there.

    ``order`` names columns of ``new`` that tell in which order its rows arrived
    (file time, position); they are not kept. Without it, or where it ties, the
    least values come first. ``existing`` is keyed, so it is neither sorted nor
    regrouped; only its keys are looked at.
    """
    fresh = keep_first(new, list(keys), _ranks(new, order)).drop(*order)
    return stack(existing, fresh.join(existing.select(*keys), list(keys), "left_anti"))


def new_wins(existing: DataFrame, new: DataFrame, keys: Sequence[str] = KEY, order: Sequence[str] = ()) -> DataFrame:
    """The last new row of each key, plus existing rows under keys that are not replaced; ``order`` as in ``existing_wins``."""
    latest = keep_last(new, list(keys), _ranks(new, order)).drop(*order)
    return stack(existing.join(latest.select(*keys), list(keys), "left_anti"), latest)


def append_rows(
    existing: DataFrame, new: DataFrame, *, max_rows: int | None = None, order: Sequence[Column] = ()
) -> DataFrame:
    """Existing and new rows, copies kept; ``max_rows`` keeps the first new rows by ``order``."""
    if max_rows is not None:
        if not order:
            raise ValueError("max_rows needs an order")
        new = new.orderBy(*order).limit(max_rows)
    return stack(existing, new)


def tag_and_stack(parts: Mapping[str, DataFrame], tag: str = "statement_type") -> DataFrame:
    """Tables of different shape in one, each row tagged with the name of its table."""
    return stack(*[df.withColumn(tag, F.lit(name)) for name, df in parts.items()])


def refresh_bound(existing: DataFrame, start: date, end: date) -> DataFrame:
    """One row: first day still to fetch, and whether there is any up to ``end``."""
    last = existing.agg(F.max(F.to_date("date")).alias("last_date"))
    known = F.col("last_date") >= F.lit(start)
    fetch_from = F.when(known, add_business_days(F.col("last_date"), 1)).otherwise(F.lit(start))
    return last.select("last_date", fetch_from.alias("fetch_from")).withColumn(
        "skip", known & (F.col("fetch_from") > F.lit(end))
    ).withColumn("skip", F.coalesce("skip", F.lit(False)))


def dataset_fingerprint(rows: DataFrame, spec: str, symbol: str = "symbol") -> DataFrame:
    """One row: 12-digit id of the set of symbols and the settings text, whatever the row order."""
    symbols = rows.select(F.col(symbol).cast("string").alias("s")).distinct()
    return symbols.agg(set_digest(F.col("s")).alias("d")).select(
        sha1_prefix(F.concat(F.lit(spec), F.lit("|"), F.col("d"))).alias("dataset_id")
    )


def append_new_prices(spark: SparkSession, path: str, new: DataFrame, order: Sequence[str] = ()) -> None:
    """Add rows with unknown keys to a month-partitioned price table, the first of each by ``order``.

    Only months the new rows fall in are read, and nothing stored is rewritten.
    Running it again with the same rows adds none, so a retried batch is safe.
    """
    span = new.agg(F.min("date").alias("a"), F.max("date").alias("b")).first()
    if span["a"] is None:
        return
    schema = with_month(new.drop(*order)).schema
    months = [int(d.strftime("%Y%m")) for d in (span["a"], span["b"])]
    known = optional_table(spark, path, schema).filter(F.col("month").between(*months)).select(*KEY)
    fresh = keep_first(new, list(KEY), _ranks(new, order)).drop(*order).join(known, list(KEY), "left_anti")
    write_table(with_month(fresh), path, partition_by="month", sort_by=["symbol", "date"], mode="append")


def replace_months(spark: SparkSession, path: str, new: DataFrame, order: Sequence[str] = ()) -> None:
    """Merge rows into a month-partitioned table; the last new rows win, untouched months stay as they are."""
    latest = with_month(keep_last(new, list(KEY), _ranks(new, order)).drop(*order))
    months = latest.select("month").distinct()
    existing = optional_table(spark, path, latest.schema).join(F.broadcast(months), "month", "left_semi")
    staged = fresh_folder(spark, "merge")
    write_table(new_wins(existing, latest), staged, partition_by="month", sort_by=["symbol", "date"])
    merged = spark.read.schema(latest.schema).parquet(staged)
    merged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("month").parquet(path)
