"""News articles as per-symbol and market-wide daily event features."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from panelkiln.functions import text
from panelkiln.functions.columns import first_present, first_value, first_with_data
from panelkiln.functions.dates import add_business_days, timestamp
from panelkiln.functions.numeric import clip, number, ratio

# Vendor column aliases.
EVENT_DATES = ("publishedDate", "published_date", "date")
SENTIMENTS = ("sentiment", "sentimentScore", "sentiment_score")
SOURCES = ("site", "publisher", "source")

SYMBOL_COLUMNS = ("news_count_1d", "news_sent_mean_1d", "news_source_nuniq_1d")
MARKET_COLUMNS = ("mkt_news_count_1d", "mkt_news_sent_mean_1d")


def article_sentiment(
    news: DataFrame, positive: Sequence[str] = text.POSITIVE_WORDS, negative: Sequence[str] = text.NEGATIVE_WORDS
) -> Column:
    """Vendor score limited to [-1, 1] if any is present, else the lexicon score of the text."""
    scored = first_with_data(news, SENTIMENTS)
    if scored:
        return clip(number(scored), -1.0, 1.0)
    parts = [F.col(c) for c in ("title", "text", "content") if c in news.columns]
    return text.sentiment(text.join_text(*parts), positive, negative) if parts else F.lit(None).cast("double")


def article_symbols(news: DataFrame, use_tickers_for_general: bool = False) -> Column:
    """Symbols an article is about: its symbol, else its ticker list, else its ticker, else the market."""
    choices = []
    if "symbol" in news.columns:
        choices.append(text.tickers(F.col("symbol"), drop_placeholders=use_tickers_for_general))
    choices += [text.tickers(F.col(c), drop_placeholders=True) for c in ("tickers", "ticker") if c in news.columns]
    return text.assigned_symbols(choices)


def article_source(news: DataFrame) -> Column:
    name = first_present(news, SOURCES)
    return F.coalesce(F.col(name).cast("string"), F.lit("unknown")) if name else F.lit("unknown")


def story_groups(
    news: DataFrame,
    *,
    shift_days: int,
    use_tickers_for_general: bool = False,
    positive: Sequence[str] = text.POSITIVE_WORDS,
    negative: Sequence[str] = text.NEGATIVE_WORDS,
) -> DataFrame:
    """Articles counted per (decision_date, symbols, source).

    Both daily tables derive from these counts, so text is scored once and the
    articles of a busy market day shrink to one row per source before any shuffle.
    """
    event_ts = first_value(news, EVENT_DATES, timestamp, "timestamp")
    return (
        news.select(
            F.to_date(event_ts).alias("event_date"),
            article_symbols(news, use_tickers_for_general).alias("symbols"),
            article_source(news).alias("source"),
            article_sentiment(news, positive, negative).alias("score"),
        )
        .dropna(subset=["event_date"])
        .withColumn("decision_date", add_business_days(F.col("event_date"), shift_days))
        .groupBy("decision_date", "symbols", "source")
        .agg(
            F.count(F.lit(1)).alias("articles"),
            F.count("score").alias("scored"),
            F.sum("score").alias("score_sum"),
        )
    )


def _mean_score() -> Column:
    return ratio(F.sum("score_sum"), F.sum("scored").cast("double"))


def news_by_symbol(groups: DataFrame) -> DataFrame:
    """Article count, mean sentiment and distinct sources per (decision_date, symbol)."""
    return (
        groups.withColumn("symbol", F.explode("symbols"))
        .groupBy("decision_date", "symbol", "source")
        .agg(*[F.sum(c).alias(c) for c in ("articles", "scored", "score_sum")])
        .groupBy("decision_date", "symbol")
        .agg(
            F.sum("articles").alias("news_count_1d"),
            _mean_score().alias("news_sent_mean_1d"),
            F.count(F.lit(1)).alias("news_source_nuniq_1d"),
        )
    )


def news_by_market(groups: DataFrame) -> DataFrame:
    """Article count and mean sentiment per decision_date, each article counted once."""
    return groups.groupBy("decision_date").agg(
        F.sum("articles").alias("mkt_news_count_1d"), _mean_score().alias("mkt_news_sent_mean_1d")
    )
