"""Panels laid out by symbol: bucketed tables whose windows and joins need no exchange.

A panel is written once with all rows of a symbol in one bucket. What Spark then
reads is already dealt by symbol, so windows over a symbol's history, aggregates
by symbol and joins of two such panels on the symbol stay where the rows are. Only
a catalog knows of buckets, so a panel is a table whose files lie in a folder of the
caller's choice; ``attach_panel`` makes the folder a table again in another session.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

BUCKETS = 64

_LAYOUT = "_layout"


def _layout_of(spark: SparkSession, path: str) -> tuple[int, list[str]]:
    (line,) = (r["value"] for r in spark.read.text(f"{path}/{_LAYOUT}").collect())
    buckets, *keys = line.split(",")
    return int(buckets), keys


def write_panel(
    df: DataFrame, path: str, *, buckets: int = BUCKETS, key: str = "symbol", sort_by: Sequence[str] = ("date",), name: str | None = None
) -> DataFrame:
    """Write rows in ``buckets`` buckets of ``key``, each sorted and in one file; the panel is read back.

    Panels that are to be joined need equal ``buckets``. A symbol's rows are bounded by the calendar, so a bucket is
    as large as its share of symbols: choose buckets so that a share fits a task.
    """
    spark, name = df.sparkSession, name or f"panel_{uuid.uuid4().hex}"
    dealt = df.repartition(buckets, key).sortWithinPartitions(key, *sort_by)
    dealt.write.mode("overwrite").option("path", path).bucketBy(buckets, key).sortBy(key, *sort_by).saveAsTable(name)
    layout = spark.range(1).select(F.lit(",".join([str(buckets), key, *sort_by])).alias("value"))
    layout.coalesce(1).write.mode("overwrite").text(f"{path}/{_LAYOUT}")
    return spark.table(name)


def append_panel(df: DataFrame, panel_path: str, table: str) -> None:
    """Add rows to a panel that has the name ``table`` in this session: one more file for each bucket that gets rows."""
    buckets, (key, *sort_by) = _layout_of(df.sparkSession, panel_path)
    dealt = df.repartition(buckets, key).sortWithinPartitions(key, *sort_by)
    dealt.write.mode("append").option("path", panel_path).bucketBy(buckets, key).sortBy(key, *sort_by).saveAsTable(table)


def attach_panel(spark: SparkSession, path: str, name: str | None = None) -> DataFrame:
    """The panel at ``path``, as a table of this session's catalog."""
    buckets, (key, *sort_by) = _layout_of(spark, path)
    name = name or f"panel_{uuid.uuid4().hex}"
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(path).schema)
    order = ", ".join(f"`{c}`" for c in [key, *sort_by])
    spark.sql(
        f"CREATE TABLE `{name}` ({columns}) USING parquet CLUSTERED BY (`{key}`) SORTED BY ({order}) INTO {buckets} BUCKETS LOCATION '{path}'"
    )
    return spark.table(name)


def with_daily_events(panel: DataFrame, events: DataFrame, *, on: str = "decision_date", key: str = "symbol") -> DataFrame:
    """Left join of ``events`` on (day, symbol), for panels dealt by symbol: neither side is exchanged.

    A plain join by day and symbol wants both sides dealt by both columns, and would exchange panels that are dealt by symbol
    alone. Here a symbol's events become one row, a map by day, which the calendar bounds; panel rows look
    their day up. ``events`` has one row for a day and symbol, otherwise that with the least values is taken.
    """
    rest = [c for c in events.columns if c not in (on, key)]
    one = events.groupBy(key, on).agg(F.min(F.struct(*rest)).alias("_event"))
    by_symbol = one.where(F.col(on).isNotNull()).groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct(on, "_event"))).alias("_events"))
    found = panel.join(by_symbol, key, "left").withColumn("_event", F.try_element_at("_events", F.col(on)))
    return found.select(*panel.columns, *[F.col(f"_event.{c}").alias(c) for c in rest])
