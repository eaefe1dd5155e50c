"""News counts from a stream of articles, with state that event time bounds.

Two streams, each with its own checkpoint. The first routes: an article that is older than the
latest one of earlier batches by more than the delay is late and goes to a side table, as do articles without
a time; the others are handed on. The second drops copies and counts days, both in
state that the watermark clears: a copy has its article's time, so it comes in time or
is late, and a day is given out once no article in time can fall in it. The second stream's watermark never is
ahead of the first's, so that it drops nothing: every article is counted, a copy, or in the side table.
"""

from __future__ import annotations

from collections.abc import Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from panelkiln.functions import text
from panelkiln.functions.columns import first_value
from panelkiln.functions.dates import add_business_days, timestamp
from panelkiln.operators.news import EVENT_DATES, article_sentiment, article_source, article_symbols
from panelkiln.session import delete_folder, folder_names, rename_folder
from panelkiln.sources.tables import optional_table

#: Where open days and seen articles are kept: on disk, so that state may be larger than memory.
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"

TIME = "published"


def dated_stories(
    news: DataFrame,
    keys: Sequence[str],
    *,
    use_tickers_for_general: bool = False,
    positive: Sequence[str] = text.POSITIVE_WORDS,
    negative: Sequence[str] = text.NEGATIVE_WORDS,
) -> DataFrame:
    """What is counted of each article: time, symbols, source and score, with a digest of what tells articles apart.

    Of copies under the same keys any one is counted; the keys should hold what is counted. Vendor scores aren't looked for in a
    stream, as that takes a pass over the whole table: text is scored.
    """
    unscored = news.drop("sentiment", "sentimentScore", "sentiment_score")
    return news.select(
        first_value(news, EVENT_DATES, timestamp, "timestamp").alias(TIME),
        article_symbols(news, use_tickers_for_general).alias("symbols"),
        article_source(news).alias("source"),
        article_sentiment(unscored, positive, negative).alias("score"),
        F.sha2(F.to_json(F.struct(*keys), {"ignoreNullFields": "false"}), 256).alias("article"),
    )


def route_stories(stories: DataFrame, in_time: str, late: str, checkpoint: str, *, delay: str) -> StreamingQuery:
    """Write each batch's stories in time below ``in_time``, and late or undated ones below ``late``; run until caught up.

    A batch's folders get their names once they are whole. A batch that is run again finds those
    of its first run, or writes them as that would have: what is late follows from the batches before.
    """

    def route(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        latest = optional_table(spark, f"{checkpoint}/latest", f"{TIME} timestamp, number long").where(F.col("number") < number)
        seen = latest.agg(F.max(TIME)).first()[0]
        bound = F.lit(seen) - F.expr(f"INTERVAL {delay}")
        is_late = F.col(TIME).isNull() if seen is None else F.coalesce(F.col(TIME) <= bound, F.lit(True))
        for path, rows in ((late, batch.where(is_late)), (in_time, batch.where(~is_late))):
            if f"batch={number}" not in folder_names(spark, path):
                staged = f"{path}/_staged/{number}"
                rows.write.mode("overwrite").parquet(staged)
                rename_folder(spark, staged, f"{path}/batch={number}")
        if f"number={number}" not in folder_names(spark, f"{checkpoint}/latest"):
            found = batch.agg(F.max(TIME).alias(TIME))
            staged = f"{checkpoint}/_latest/{number}"
            found.write.mode("overwrite").parquet(staged)
            rename_folder(spark, staged, f"{checkpoint}/latest/number={number}")
        for number_before in folder_names(spark, f"{checkpoint}/latest"):
            # One row for each batch would add up over years; the last hundred hold the latest time of all before.
            if number_before.startswith("number=") and int(number_before[7:]) < number - 100:
                _fold_latest(spark, checkpoint, number - 100)
                break

    return stories.writeStream.foreachBatch(route).option("checkpointLocation", f"{checkpoint}/stream").trigger(availableNow=True).start()


def _fold_latest(spark: SparkSession, checkpoint: str, upto: int) -> None:
    """Put the latest times of batches before ``upto`` in one row, under the number -1."""
    latest = spark.read.schema(f"{TIME} timestamp, number long").parquet(f"{checkpoint}/latest").where(F.col("number") < upto)
    staged = f"{checkpoint}/_latest/folded"
    latest.agg(F.max(TIME).alias(TIME)).write.mode("overwrite").parquet(staged)
    old = [n for n in folder_names(spark, f"{checkpoint}/latest") if n.startswith("number=") and int(n[7:]) < upto]
    # The new row stands beside the old one before that goes: the latest time is never forgotten.
    rename_folder(spark, staged, f"{checkpoint}/latest/number={-2 if 'number=-1' in old else -1}")
    for name in old:
        delete_folder(spark, f"{checkpoint}/latest/{name}")


@contextmanager
def _state_on_disk(spark: SparkSession):
    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, STATE_STORE)
    try:
        yield
    finally:
        spark.conf.set(_PROVIDER, before) if before else spark.conf.unset(_PROVIDER)


def count_stories(spark: SparkSession, in_time: str, out: str, checkpoint: str, *, delay: str, batches_at_once: int = 1) -> StreamingQuery:
    """Append the counts of each day, symbols and source below ``out`` once the day is over; run until caught up.

    Days are those of the session's time zone only if that is UTC. State: articles younger than the delay and the counts of open days.
    """
    schema = f"{TIME} timestamp, symbols array<string>, source string, score double, article string"
    stories = spark.readStream.schema(schema).option("maxFilesPerTrigger", batches_at_once).parquet(in_time)
    once = stories.withWatermark(TIME, delay).dropDuplicatesWithinWatermark(["article"])
    counted = once.groupBy(F.window(TIME, "1 day").alias("day"), "symbols", "source").agg(
        F.count(F.lit(1)).alias("articles"), F.count("score").alias("scored"), F.sum("score").alias("score_sum")
    )
    rows = counted.select(F.to_date("day.start").alias("event_date"), "symbols", "source", "articles", "scored", "score_sum")
    with _state_on_disk(spark):
        return rows.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def counted_groups(spark: SparkSession, out: str, *, shift_days: int) -> DataFrame:
    """The days given out so far, as ``operators.news.story_groups`` has them: what daily news features are built from."""
    schema = "event_date date, symbols array<string>, source string, articles long, scored long, score_sum double"
    days = optional_table(spark, out, schema).withColumn("decision_date", add_business_days(F.col("event_date"), shift_days))
    return days.groupBy("decision_date", "symbols", "source").agg(*[F.sum(c).alias(c) for c in ("articles", "scored", "score_sum")])


def refresh_news(
    spark: SparkSession, news: DataFrame, folder: str, keys: Sequence[str], *, delay: str = "3 days", **scoring
) -> tuple[StreamingQuery, StreamingQuery]:
    """Route and count what a stream of vendor articles brings, and wait for both; late articles are below ``{folder}/late``."""
    places = [f"{folder}/{n}" for n in ("in_time", "late", "route")]
    routed = route_stories(dated_stories(news, keys, **scoring), *places, delay=delay)
    routed.awaitTermination()
    counted = count_stories(spark, places[0], f"{folder}/counts", f"{folder}/count", delay=delay)
    counted.awaitTermination()
    return routed, counted
