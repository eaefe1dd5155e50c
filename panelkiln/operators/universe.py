"""Point-in-time universe membership from add/remove events.

Each symbol's history is independent, so the current list is rolled back and
replayed with aggregates and one window per symbol instead of a set carried
from day to day.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import UTC, date, datetime, timedelta

from pyspark.sql import DataFrame, Window, functions as F

from panelkiln.functions.columns import first_value, symbol_name
from panelkiln.functions.dates import add_business_days, day, is_business_day
from panelkiln.functions.text import ticker_from_json
from panelkiln.session import stored

# Vendor column aliases.
ADDED_COLUMNS = (
    "addedSymbol", "added_symbol", "addedSecuritySymbol", "symbolAdded",
    "addedTicker", "added", "addedSecurity", "newSymbol",
)
REMOVED_COLUMNS = (
    "removedSymbol", "removed_symbol", "removedSecuritySymbol", "symbolRemoved",
    "removedTicker", "removed", "removedSecurity", "oldSymbol",
)
EVENT_DATES = ("date", "effectiveDate", "eventDate")


def membership_events(raw: DataFrame, order: str) -> DataFrame:
    """(event_date, seq, added, removed) with clean tickers; ``order`` is the position in the feed."""

    def clean(name: str):
        return ticker_from_json(F.col(name))

    return raw.select(
        first_value(raw, EVENT_DATES, day, "date").alias("event_date"),
        F.col(order).alias("seq"),
        first_value(raw, ADDED_COLUMNS, clean).alias("added"),
        first_value(raw, REMOVED_COLUMNS, clean).alias("removed"),
    ).dropna(subset=["event_date"])


def symbol_changes(events: DataFrame) -> DataFrame:
    """One row per change of one symbol: (symbol, removed, event_date, seq)."""
    change = F.explode(
        F.array(
            F.struct(F.col("added").alias("symbol"), F.lit(False).alias("removed")),
            F.struct(F.col("removed").alias("symbol"), F.lit(True).alias("removed")),
        )
    )
    return events.select("event_date", "seq", change.alias("c")).select("c.*", "event_date", "seq").dropna(
        subset=["symbol"]
    )


def membership_intervals(current: DataFrame, events: DataFrame, start: date, end: date) -> DataFrame:
    """(symbol, from_date, to_date) spans of membership within [start, end].

    ``current`` lists today's members; ``events`` come from ``membership_events``.
    An event takes effect on its own day, or the next business day after a
    weekend. Within one event a removal comes after an addition.
    """
    changes = symbol_changes(events).filter(F.col("event_date") >= F.lit(start))

    # State before the first change: a symbol that is next removed was a member,
    # one that is next added was not, one that never changes is as it is today.
    first_change = F.min_by("removed", F.struct("event_date", "seq", ~F.col("removed")))
    today = current.select(
        symbol_name("symbol").alias("symbol"),
        F.lit(True).alias("listed"),
        F.lit(None).cast("boolean").alias("removed"),
    )
    initial = (
        changes.groupBy("symbol")
        .agg(first_change.alias("removed"))
        .unionByName(today, allowMissingColumns=True)
        .groupBy("symbol")
        .agg(F.bool_or("removed").alias("removed"), F.bool_or("listed").alias("listed"))
        .select(
            "symbol",
            F.lit(start).alias("from_date"),
            F.lit(0).alias("step"),
            F.coalesce("removed", "listed", F.lit(False)).alias("member"),
        )
    )
    own_day = F.when(is_business_day(F.col("event_date")), F.col("event_date"))
    effective = (
        changes.withColumn("from_date", F.coalesce(own_day, add_business_days(F.col("event_date"), 1)))
        .filter(F.col("from_date") <= F.lit(end))
        .groupBy("symbol", "from_date")
        .agg((~F.max_by("removed", F.struct("event_date", "seq", "removed"))).alias("member"))
        .withColumn("step", F.lit(1))
    )
    w = Window.partitionBy("symbol").orderBy("from_date", "step")
    before = F.lag("member").over(w)
    return (
        initial.unionByName(effective)
        .withColumn("changed", before.isNull() | (before != F.col("member")))
        .filter("changed")
        .withColumn("to_date", F.coalesce(F.date_sub(F.lead("from_date").over(w), 1), F.lit(end)))
        .filter(F.col("member") & (F.col("from_date") <= F.col("to_date")))
        .select("symbol", "from_date", "to_date")
    )


@dataclass(frozen=True)
class Universe:
    """Membership spans, and how they were come by."""

    spans: DataFrame
    provider: str
    end: date
    end_truncated: bool
    fallback_reason: str = ""


def point_in_time(current: DataFrame, events: DataFrame, start: date, end: date, today: date | None = None) -> Universe:
    """Replayed membership up to ``end`` or today, whichever is earlier.

    An empty list of current members, a range without business days and a
    range without members are errors.
    """
    today = today or datetime.now(UTC).date()
    last = min(end, today)
    days = (start + timedelta(n) for n in range(min(7, (last - start).days + 1)))
    if not any(d.weekday() < 5 for d in days):
        raise ValueError("no business days in the requested range")
    if current.filter(symbol_name("symbol").isNotNull()).isEmpty():
        raise ValueError("no current members")
    spans = membership_intervals(current, events, start, last)
    if spans.isEmpty():
        raise ValueError("no members in the requested range")
    return Universe(spans, "point_in_time", last, last < end)


def resolve_universe(
    start: date,
    end: date,
    *,
    custom: DataFrame | None = None,
    current: DataFrame | None = None,
    events: DataFrame | None = None,
    fallback: DataFrame | None = None,
    today: date | None = None,
) -> Universe:
    """The custom list if given, else the replayed index, else the fallback list; says which.

    Without a fallback list, what is wrong with the replay is the error.
    """
    if custom is not None:
        if custom.isEmpty():
            raise ValueError("the custom list has no symbols")
        return Universe(static_spans(custom, start, end), "custom_list", end, False)
    today = today or datetime.now(UTC).date()
    try:
        if current is None or events is None:
            raise ValueError("no index tables")
        return point_in_time(current, events, start, end, today)
    except ValueError as error:
        if fallback is None:
            raise
        if fallback.isEmpty():
            raise ValueError("the fallback list has no symbols") from error
        # The list holds up to the end that was asked for, as no replay bounds it.
        return Universe(static_spans(fallback, start, end), "fallback", min(end, today), end > today, str(error))


def membership_days(intervals: DataFrame) -> DataFrame:
    """Intervals spelled out as (date, symbol, is_member) rows on business days."""
    every_day = F.explode(F.sequence("from_date", "to_date"))
    days = intervals.filter(F.col("from_date") <= F.col("to_date")).select(every_day.alias("date"), "symbol")
    # Filtering the exploded rows, not the array, keeps the work in generated code.
    return days.filter(is_business_day(F.col("date"))).withColumn("is_member", F.lit(True))


def members_by_day(intervals: DataFrame) -> DataFrame:
    """(date, members, first_symbol, last_symbol) of the days spelled out.

    Spark has to sort rows to find the least text of a group. So symbols are numbered in their order first, the days are
    counted with numbers, which combine map-side without a sort, and two numbers a day are names again.
    """
    spans = stored(intervals, "spans")
    names = spans.select("symbol").where(F.col("symbol").isNotNull()).distinct().orderBy("symbol")
    names = stored(names.withColumn("number", F.monotonically_increasing_id()), "names")
    numbered = spans.join(names, "symbol", "left").select(F.col("number").alias("symbol"), "from_date", "to_date")
    days = membership_days(numbered).groupBy("date").agg(F.count(F.lit(1)).alias("members"), F.min("symbol").alias("first"), F.max("symbol").alias("last"))
    # One row a day: small enough to travel to the names.
    days = stored(days, "days")
    ends = days.select("date", F.explode(F.array("first", "last")).alias("number")).where(F.col("number").isNotNull()).distinct()
    found = names.join(F.broadcast(ends), "number").groupBy("date").agg(F.min("symbol").alias("first_symbol"), F.max("symbol").alias("last_symbol"))
    return days.select("date", "members").join(found, "date", "left")


def static_spans(symbols: DataFrame, start: date, end: date) -> DataFrame:
    """Every listed symbol as one span (symbol, from_date, to_date)."""
    return symbols.select(
        symbol_name("symbol").alias("symbol"), F.lit(start).alias("from_date"), F.lit(end).alias("to_date")
    ).distinct()


def static_membership(symbols: DataFrame, start: date, end: date) -> DataFrame:
    """Every listed symbol, a member on every business day of [start, end], day by day.

    To filter a panel, ``static_spans`` with ``members_within`` does without the days.
    """
    return membership_days(static_spans(symbols, start, end))


def members_within(panel: DataFrame, intervals: DataFrame, on: str = "decision_date") -> DataFrame:
    """Panel rows inside a membership span, without spelling the spans out.

    Spans of a symbol do not overlap, so no row repeats.
    """
    spans = intervals.select(F.col("symbol").alias("_s"), "from_date", "to_date")
    inside = (F.col("symbol") == F.col("_s")) & F.col(on).between(F.col("from_date"), F.col("to_date"))
    return panel.join(spans, inside, "left_semi")
