"""The stateful news stream against the batch operators."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from panelkiln.operators import news as news_ops
from panelkiln.session import fresh_folder
from panelkiln.streaming import news as stream, refresh

KEY = ["publishedDate", "symbol", "title", "site"]
SCHEMA = "publishedDate string, symbol string, title string, site string"
START = dt.datetime(2024, 3, 1)
DELAY = dt.timedelta(days=3)


def feed(seed, batches=9, rows=60):
    """Batches about two days apart; some articles come days late, some twice, some have no time."""
    rng, out = random.Random(seed), []
    for b in range(batches):
        batch = []
        for _ in range(rows):
            at = START + dt.timedelta(days=2 * b + 2 * rng.random() - (rng.choice([1, 2.5, 6, 9]) if rng.random() < 0.2 else 0))
            text = " ".join(rng.choice(["beats", "weak", "shares", "gains"]) for _ in range(4))
            batch.append((at.strftime("%Y-%m-%d %H:%M:%S"), rng.choice(["A", "B, C", "GENERAL", None]), text, rng.choice(["x", "y", None])))
        batch += batch[:5] + (rng.sample(out[-1], 8) if out else []) + [(None, "A", "no time", "x")]
        out.append(batch)
    return out


def split(batches):
    """(in time, late) by the rule: not over the delay behind the latest of earlier batches."""
    latest, kept, late = None, [], []
    for batch in batches:
        for r in batch:
            at = r[0] and dt.datetime.fromisoformat(r[0])
            (kept if at and (latest is None or at > latest - DELAY) else late).append(r)
        latest = max([x for x in [latest, *(dt.datetime.fromisoformat(r[0]) for r in batch if r[0])] if x])
    return kept, late, latest


def rows_of(df):
    return sorted(((r.decision_date, tuple(r.symbols), r.source, r.articles, r.scored, round(r.score_sum, 9)) for r in df.collect()), key=repr)


def run(spark, batches, at_once=1):
    landing, folder = fresh_folder(spark, "t-feed"), fresh_folder(spark, "t-news")
    progress = None
    for i in range(0, len(batches), at_once):
        for batch in batches[i : i + at_once]:
            spark.createDataFrame(batch, SCHEMA).coalesce(1).write.mode("append").parquet(landing)
        news = refresh.parquet_stream(spark, landing, files_per_batch=1)
        _, counted = stream.refresh_news(spark, news, folder, KEY)
        progress = counted.lastProgress or progress
    return folder, progress


@pytest.mark.parametrize("at_once", [1, 9])
def test_closed_days_equal_the_batch_operator_and_late_rows_stand_aside(spark, at_once):
    batches = feed(at_once)
    folder, progress = run(spark, batches, at_once)
    kept, late, latest = split(batches)
    assert len(late) > len(batches) and len(kept) > len(late)
    side = spark.read.parquet(f"{folder}/late")
    assert side.count() == len(late) and side.where("published IS NULL").count() == len(batches)
    in_time = spark.createDataFrame(sorted(set(kept), key=repr), SCHEMA)
    over = (latest - DELAY).date()  # its day is still open
    closed = in_time.where(F.to_date("publishedDate") < F.lit(over))
    assert rows_of(stream.counted_groups(spark, f"{folder}/counts", shift_days=1)) == rows_of(news_ops.story_groups(closed, shift_days=1))
    days = [o["numRowsTotal"] for o in progress["stateOperators"]]
    recent = {r for r in kept if dt.datetime.fromisoformat(r[0]) > latest - 2 * DELAY}
    assert len(days) == 2 and max(days) <= len(recent)
    assert all(any(m.startswith("rocksdb") for m in o["customMetrics"]) for o in progress["stateOperators"])


def test_a_batch_that_is_routed_again_adds_nothing(spark):
    batches = feed(5, batches=3)
    landing, folder = fresh_folder(spark, "t-feed"), fresh_folder(spark, "t-news")
    for batch in batches:
        spark.createDataFrame(batch, SCHEMA).coalesce(1).write.mode("append").parquet(landing)
    for attempt in range(2):  # the second run has lost its checkpoint, as if its batches had never been committed
        news = refresh.parquet_stream(spark, landing, files_per_batch=1)
        stories = stream.dated_stories(news, KEY)
        query = stream.route_stories(stories, f"{folder}/in", f"{folder}/late", f"{folder}/route", delay="3 days")
        query.awaitTermination()
        assert spark.read.parquet(f"{folder}/in").count() + spark.read.parquet(f"{folder}/late").count() == sum(map(len, batches))
        stream.delete_folder(spark, f"{folder}/route/stream")


def test_latest_times_are_folded(spark):
    checkpoint = fresh_folder(spark, "t-latest")
    for n in (-1, 0, 1, 2, 3):
        one = spark.createDataFrame([(START + dt.timedelta(days=-n),)], "published timestamp")
        one.write.parquet(f"{checkpoint}/latest/number={n}")
    stream._fold_latest(spark, checkpoint, 3)
    assert sorted(stream.folder_names(spark, f"{checkpoint}/latest")) == ["number=-2", "number=3"]
    assert spark.read.parquet(f"{checkpoint}/latest").agg(F.max("published")).first()[0] == START + dt.timedelta(days=1)
    stream._fold_latest(spark, checkpoint, 3)
    assert sorted(stream.folder_names(spark, f"{checkpoint}/latest")) == ["number=-1", "number=3"]
