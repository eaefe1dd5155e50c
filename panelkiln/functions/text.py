"""Headline text: lexicon sentiment and ticker lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from panelkiln.functions.numeric import ratio

# The default sentiment lexicon.
POSITIVE_WORDS = (
    "beat", "beats", "bullish", "buy", "growth", "gain", "gains", "improve", "improves", "improved",
    "optimistic", "outperform", "strong", "upgrade", "upside",
)
NEGATIVE_WORDS = (
    "bearish", "cut", "cuts", "decline", "declines", "downgrade", "drop", "drops", "fall", "falls",
    "miss", "misses", "risk", "risks", "warning", "weak",
)

# Symbols that stand for "no single company", and the ticker formats.
PLACEHOLDER_SYMBOLS = ("GENERAL", "MARKET", "ALL", "GLOBAL")
MARKET_SYMBOL = "GENERAL"
WORD_PATTERN = "[a-z']+"
TICKER_SEPARATORS = r"[,;\s|]+"
TICKER_PATTERN = r"^[A-Z0-9][A-Z0-9.\-]{0,9}$"


def sentiment(
    text: Column, positive: Sequence[str] = POSITIVE_WORDS, negative: Sequence[str] = NEGATIVE_WORDS
) -> Column:
    """(positive words - negative words) / words; NULL when the text has no word."""
    words = F.regexp_extract_all(F.lower(text), F.lit(WORD_PATTERN), F.lit(0))

    def value(word: Column) -> Column:
        return F.when(word.isin(list(positive)), 1.0).otherwise(0.0) - F.when(word.isin(list(negative)), 1.0).otherwise(0.0)

    # One fold, so the text is cut into words once.
    return F.aggregate(
        words,
        F.struct(F.lit(0.0).alias("total"), F.lit(0.0).alias("n")),
        lambda acc, w: F.struct((acc["total"] + value(w)).alias("total"), (acc["n"] + 1.0).alias("n")),
        lambda acc: ratio(acc["total"], acc["n"]),
    )


def join_text(*parts: Column) -> Column:
    """Parts joined by a blank; a missing part is empty."""
    return F.concat_ws(" ", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])


def tickers(value: Column, drop_placeholders: bool = False) -> Column:
    """Array of the distinct tickers in a free-form list, in order of appearance."""
    raw = F.upper(F.trim(value.cast("string")))
    spaced = F.translate(raw, "/\\", "  ")
    names = F.transform(
        F.split(spaced, TICKER_SEPARATORS), lambda t: F.trim(F.element_at(F.split(t, ":"), -1))
    )
    kept = F.filter(names, lambda t: t.rlike(TICKER_PATTERN))
    if drop_placeholders:
        kept = F.filter(kept, lambda t: ~t.isin(list(PLACEHOLDER_SYMBOLS)))
    nothing = F.array().cast("array<string>")
    return F.when(raw.isNull() | raw.isin("", "NAN", "NONE"), nothing).otherwise(F.array_distinct(kept))


def first_ticker(value: Column) -> Column:
    return F.coalesce(F.get(tickers(value), F.lit(0)), F.lit(MARKET_SYMBOL))


def assigned_symbols(candidates: Sequence[Column]) -> Column:
    """The first non-empty ticker array, else the market symbol alone."""
    chosen = F.array(F.lit(MARKET_SYMBOL))
    for names in reversed(candidates):
        chosen = F.when(F.size(names) > 0, names).otherwise(chosen)
    return chosen


def ticker_or_null(value: Column) -> Column:
    """A single clean ticker; company names and blanks become NULL."""
    name = F.upper(F.trim(value.cast("string")))
    return F.when(name.rlike(TICKER_PATTERN), name)


def ticker_from_json(value: Column) -> Column:
    """Ticker from a JSON value: plain text, or an object with a symbol or ticker field."""
    text = F.trim(value.cast("string"))
    # A JSON object starts with a brace; anything else is the ticker itself.
    fields = F.coalesce(
        *[
            ticker_or_null(F.get_json_object(text, f"$.{name}"))
            for name in ("symbol", "ticker", "Symbol", "Ticker")
        ]
    )
    return F.when(text.startswith("{"), fields).otherwise(ticker_or_null(text))
