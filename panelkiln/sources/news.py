"""Landing of news articles."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from panelkiln.functions.columns import first_present
from panelkiln.functions.dates import day
from panelkiln.functions.digests import set_digest
from panelkiln.functions.text import MARKET_SYMBOL
from panelkiln.operators.rows import keep_last, stack

# Vendor columns.
EVENT_DATES = ("publishedDate", "published_date", "date")
ARTICLE_KEY = ("symbol", "publishedDate", "date", "title", "url", "link")
PAGE_CONTENT = ("publishedDate", "published_date", "date", "title", "url", "link", "symbol", "tickers", "ticker")


def event_day(news: DataFrame) -> Column:
    name = first_present(news, EVENT_DATES)
    return day(name) if name else F.lit(None).cast("date")


def clip_articles(news: DataFrame, start: date | None, end: date | None) -> DataFrame:
    """Dated articles within [start, end]; a table without symbols is about the market."""
    dated = news.withColumn("_day", event_day(news)).filter(F.col("_day").isNotNull())
    if start is not None:
        dated = dated.filter(F.col("_day") >= F.lit(start))
    if end is not None:
        dated = dated.filter(F.col("_day") <= F.lit(end))
    if "symbol" not in news.columns:
        dated = dated.withColumn("symbol", F.lit(MARKET_SYMBOL))
    return dated.drop("_day")


def land_articles(existing: DataFrame, *batches: DataFrame, order: Sequence[str] = ()) -> DataFrame:
    """All articles once; of copies with the same key columns the last of the latest batch stays.

    ``order`` names columns that tell in which order a batch's articles arrived;
    they are not kept. Without it, or where it ties, the greatest values come last.
    """
    tables = [df.withColumn("_batch", F.lit(i)) for i, df in enumerate((existing, *batches))]
    articles = stack(*tables)
    keys = [c for c in ARTICLE_KEY if c in articles.columns]
    rest = [F.col(c) for c in articles.columns if c not in keys and c not in order and c != "_batch"]
    return keep_last(articles, keys, [F.col("_batch"), *map(F.col, order), *rest]).drop("_batch", *order)


def page_markers(articles: DataFrame, page: str = "page", position: str = "position") -> DataFrame:
    """(page, marker): a digest of a page's articles in their order, merged from per-row parts."""
    content = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in PAGE_CONTENT if c in articles.columns]
    row = F.concat_ws("|", F.col(position).cast("string"), *content)
    return articles.groupBy(page).agg(set_digest(row).alias("marker"))


def drop_repeated_pages(articles: DataFrame, page: str = "page", position: str = "position") -> DataFrame:
    """Articles without the pages whose content was served on an earlier page."""
    first_seen = page_markers(articles, page, position).groupBy("marker").agg(F.min(page).alias(page))
    return articles.join(first_seen.select(page), page, "left_semi")
