"""The assembled feature table: price features of members with earnings and news events."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from panelkiln.functions.columns import symbol_name
from panelkiln.functions.dates import is_business_day
from panelkiln.functions.frames import history, rolling, upto
from panelkiln.functions.numeric import fill_zero
from panelkiln.operators import news as news_ops
from panelkiln.operators.earnings import earnings_events
from panelkiln.operators.price_features import build_price_features
from panelkiln.operators.rows import attach_daily
from panelkiln.operators.universe import members_within
from panelkiln.session import stored

KEY = ["decision_date", "symbol"]
NOT_FEATURES = ("decision_date", "symbol", "label_date", "horizon", "feature_available_date", "feature_version")


def member_days(membership: DataFrame) -> DataFrame:
    """(decision_date, symbol) of the days a symbol is a member."""
    return membership.filter(F.col("is_member")).select(
        F.to_date("date").alias("decision_date"), symbol_name("symbol").alias("symbol")
    )


def members_only(panel: DataFrame, membership: DataFrame) -> DataFrame:
    """Panel rows on days the symbol is a member.

    ``membership`` lists days (date, symbol, is_member) or spans (symbol,
    from_date, to_date), which hold on their business days and are not spelled out.
    """
    if {"from_date", "to_date"} <= set(membership.columns):
        return members_within(panel, membership).filter(is_business_day(F.col("decision_date")))
    return panel.join(member_days(membership), KEY, "left_semi")


def without_symbols(panel: DataFrame, excluded: DataFrame) -> DataFrame:
    """Rows whose symbol is not listed, letter case ignored."""
    names = excluded.select(symbol_name("symbol").alias("_name")).distinct()
    return panel.join(names, symbol_name(panel["symbol"]) == names["_name"], "left_anti")


def with_earnings(features: DataFrame, earnings: DataFrame | None, shift_days: int) -> DataFrame:
    """Earnings events joined on; days without one carry 0."""
    if earnings is not None:
        features = features.join(earnings_events(earnings, shift_days=shift_days), KEY, "left")
    return fill_zero(features, ["earnings_event", "eps_surprise"])


def with_news(features: DataFrame, groups: DataFrame) -> DataFrame:
    """Daily news counts joined on, then rolled over each symbol's own rows."""
    by_symbol = news_ops.news_by_symbol(groups).filter(F.col("symbol") != news_ops.text.MARKET_SYMBOL)
    joined = features.join(by_symbol, KEY, "left")
    joined = attach_daily(joined, news_ops.news_by_market(groups), "decision_date")
    return rolling_news(fill_zero(joined, [*news_ops.SYMBOL_COLUMNS, *news_ops.MARKET_COLUMNS]))


def rolling_news(features: DataFrame) -> DataFrame:
    """Rolling news features; the current row counts, as its news is already shifted."""
    w = history("decision_date")
    f5, f20 = upto(w, 5), upto(w, 20)
    sentiment = F.col("news_sent_mean_1d")
    rolled = features.withColumns(
        {
            "news_count_5d": F.sum("news_count_1d").over(f5),
            "news_count_20d": F.sum("news_count_1d").over(f20),
            "news_sent_mean_5d": F.avg(sentiment).over(f5),
            "news_sent_std_20d": rolling(F.stddev_samp(sentiment), sentiment, f20, 2),
            "mkt_news_count_20d": F.sum("mkt_news_count_1d").over(f20),
            "mkt_news_sent_mean_5d": F.avg("mkt_news_sent_mean_1d").over(f5),
        }
    ).withColumn("news_attention_20d", F.col("news_count_20d") / (F.col("mkt_news_count_20d") + F.lit(1e-12)))
    return fill_zero(rolled, ["news_sent_std_20d"])


def build_feature_store(
    *,
    prices: DataFrame,
    membership: DataFrame,
    earnings: DataFrame | None = None,
    news: DataFrame | None = None,
    adjusted: bool = False,
    lookbacks: Sequence[int] = (1, 5, 20, 60, 120),
    shift_days: int = 1,
    use_tickers_for_general: bool = False,
    include_raw_return: bool = False,
    positive: Sequence[str] = news_ops.text.POSITIVE_WORDS,
    negative: Sequence[str] = news_ops.text.NEGATIVE_WORDS,
) -> DataFrame:
    """All features per (decision_date, symbol) of the universe; a universe without members is an error."""
    if membership.isEmpty():
        raise ValueError("membership is empty")
    features = build_price_features(
        prices, adjusted=adjusted, lookbacks=lookbacks, include_raw_return=include_raw_return
    )
    features = with_earnings(members_only(features, membership), earnings, shift_days)
    if news is not None:
        groups = news_ops.story_groups(
            news,
            shift_days=shift_days,
            use_tickers_for_general=use_tickers_for_general,
            positive=positive,
            negative=negative,
        )
        # Counts are small next to the articles; stored, the text is scored once for both daily tables.
        features = with_news(features, stored(groups, "story-groups"))
    return features


def merge_labels(features: DataFrame, labels: DataFrame) -> DataFrame:
    return features.join(labels, KEY, "inner")


def select_features(
    columns: Sequence[str],
    target: str,
    exclude_prefixes: Sequence[str] = (),
    exclude_patterns: Sequence[str] = (),
) -> list[str]:
    """Names of the model inputs among ``columns`` after the exclusions."""
    try:
        patterns = [re.compile(p) for p in exclude_patterns if p]
    except re.error as error:
        raise ValueError(f"invalid exclude pattern: {error}") from error
    prefixes = tuple(p for p in exclude_prefixes if p)
    kept = [
        c
        for c in columns
        if c not in NOT_FEATURES
        and c != target
        and not (prefixes and c.startswith(prefixes))
        and not any(p.search(c) for p in patterns)
    ]
    if not kept:
        raise ValueError("no features left after the exclusions")
    return kept
