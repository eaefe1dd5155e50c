"""Landing files to stored tables, as streams that run until caught up and resume from their checkpoint."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from panelkiln.operators.rows import keep_first
from panelkiln.sources.landing import envelope_schema, landed_prices
from panelkiln.sources.store import append_new_prices
from panelkiln.sources.tables import optional_table


def refresh_prices(
    spark: SparkSession, landing: str, store: str, checkpoint: str, *, files_per_batch: int = 1000, one_per_file: bool = False
) -> StreamingQuery:
    """Stream landed price envelopes into the price table; rows already stored win.

    A batch replayed after a failure finds its keys stored and adds nothing.
    """
    reader = spark.readStream.schema(envelope_schema()).option("maxFilesPerTrigger", files_per_batch)
    envelopes = reader.option("multiLine", one_per_file).json(landing)

    def merge(batch: DataFrame, _: int) -> None:
        append_new_prices(batch.sparkSession, store, landed_prices(batch))

    return (
        envelopes.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def land_stream(
    articles: DataFrame, path: str, checkpoint: str, keys: Sequence[str], *, day: str | None = None
) -> StreamingQuery:
    """Append a stream of articles to a Parquet table, the first of each key, however late it comes.

    Each batch is held against the keys already stored. With ``day``, a date among the keys, the table is
    partitioned by it and only the days between the batch's first and last are read. Keys
    may be NULL. A batch replayed after a failure adds nothing.
    """

    def merge(batch: DataFrame, _: int) -> None:
        spark = batch.sparkSession
        order = [F.col(c) for c in batch.columns if c not in keys]
        fresh = keep_first(batch, list(keys), order or [F.lit(0)]).select(*batch.columns)
        known = optional_table(spark, path, batch.schema).select(*[F.col(k).alias(f"_{k}") for k in keys])
        if day:
            first, last = batch.agg(F.min(day), F.max(day)).first()
            known = known.filter(F.col(f"_{day}").between(first, last) | F.col(f"_{day}").isNull())
        same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])
        writer = fresh.join(known, same, "left_anti").write.mode("append")
        (writer.partitionBy(day) if day else writer).parquet(path)

    return (
        articles.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def parquet_stream(spark: SparkSession, path: str, *, files_per_batch: int = 100) -> DataFrame:
    """A Parquet table, one file or a folder, as a stream."""
    schema = spark.read.parquet(path).schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)
