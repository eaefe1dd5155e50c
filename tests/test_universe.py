import datetime as dt
import random

import pandas as pd
import pytest

from panelkiln.operators import universe

START, END = dt.date(2024, 1, 3), dt.date(2024, 2, 16)


def replay(current, events):
    """Membership day by day: roll today's set back, then apply each change on its day."""
    members = set(current)
    for day, _, added, removed in sorted(events, key=lambda e: (e[0], e[1]), reverse=True):
        if day >= START:
            members.discard(added)
            if removed:
                members.add(removed)
    days = [d.date() for d in pd.bdate_range(START, END)]
    out = set()
    for today in days:
        for day, _, added, removed in sorted(events, key=lambda e: (e[0], e[1])):
            acts = day if day.weekday() < 5 else (pd.Timestamp(day) + pd.offsets.BDay(1)).date()
            if START <= day <= END and acts == today:
                if added:
                    members.add(added)
                if removed:
                    members.discard(removed)
        out |= {(today, m) for m in members}
    return out


def test_intervals_equal_a_sequential_replay(spark):
    rng = random.Random(5)
    current, events, want = [], [], set()
    for history in range(40):
        names = [f"H{history}.{i}" for i in range(4)]
        mine = [
            (
                dt.date(2023, 12, 20) + dt.timedelta(days=rng.randrange(75)), seq,
                rng.choice([*names, None]), rng.choice([*names, None]),
            )
            for seq in range(rng.randrange(9))
        ]
        today = rng.sample(names, 2)
        current += today
        events += [(d, history * 100 + s, a, r) for d, s, a, r in mine]
        want |= replay(today, mine)
    raw = spark.createDataFrame(
        [(str(d), s, a, r) for d, s, a, r in events], "effectiveDate string, seq int, addedTicker string, removedSymbol string"
    )
    members = spark.createDataFrame([(c,) for c in current], "symbol string")
    spans = universe.membership_intervals(members, universe.membership_events(raw, "seq"), START, END)
    got = [(r["date"], r["symbol"]) for r in universe.membership_days(spans).collect()]
    assert len(got) == len(set(got))
    assert set(got) == want

    panel = spark.createDataFrame(
        [(d.date(), c) for d in pd.bdate_range(START, END) for c in current], "decision_date date, symbol string"
    )
    kept = {(r[0], r[1]) for r in universe.members_within(panel, spans).select("decision_date", "symbol").collect()}
    assert kept == {w for w in want if w[1] in current}


def test_static_membership_covers_business_days(spark):
    names = spark.createDataFrame([(" aaa ",), ("AAA",), ("b",)], "symbol string")
    rows = universe.static_membership(names, dt.date(2024, 3, 1), dt.date(2024, 3, 5)).collect()
    assert {(r["symbol"], r["date"].day) for r in rows} == {(s, d) for s in ("AAA", "B") for d in (1, 4, 5)}
    assert len(rows) == 6 and all(r["is_member"] for r in rows)


def test_universe_is_resolved_and_says_how(spark):
    current = spark.createDataFrame([("aaa",), ("BBB",)], "symbol string")
    nobody = current.limit(0)
    raw = spark.createDataFrame([("2024-03-05", "AAA", "CCC", 1)], "date string, added string, removed string, seq int")
    events = universe.membership_events(raw, "seq")
    start, end, today = dt.date(2024, 3, 1), dt.date(2024, 3, 29), dt.date(2024, 3, 15)
    found = universe.resolve_universe(start, end, current=current, events=events, fallback=current, today=today)
    assert (found.provider, found.end, found.end_truncated, found.fallback_reason) == ("point_in_time", today, True, "")
    assert {tuple(r) for r in found.spans.collect()} == {
        ("AAA", dt.date(2024, 3, 5), today), ("BBB", start, today), ("CCC", start, dt.date(2024, 3, 4))
    }
    found = universe.resolve_universe(start, end, custom=current, today=today)
    assert (found.provider, found.spans.count()) == ("custom_list", 2)
    found = universe.resolve_universe(start, end, current=nobody, events=events, fallback=current, today=today)
    assert (found.provider, found.end_truncated, found.fallback_reason) == ("fallback", True, "no current members")
    for arguments, message in (
        ({"current": nobody, "events": events}, "no current members"),
        ({"current": nobody, "events": events, "fallback": nobody}, "fallback list has no symbols"),
        ({"custom": nobody}, "custom list has no symbols"),
    ):
        with pytest.raises(ValueError, match=message):
            universe.resolve_universe(start, end, today=today, **arguments)
    with pytest.raises(ValueError, match="no business days"):
        universe.point_in_time(current, events, dt.date(2024, 3, 2), dt.date(2024, 3, 3), today)
