"""Small frames and comparisons for the tests."""

import datetime as dt

import numpy as np
import pandas as pd

PRICE_SCHEMA = (
    "symbol string, date date, open double, high double, low double, close double, adj_close double, volume double"
)


def weekdays(start, n):
    days, day = [], pd.Timestamp(start).date()
    while len(days) < n:
        if day.weekday() < 5:
            days.append(day)
        day += dt.timedelta(days=1)
    return days


def random_prices(seed=0, symbols=4, rows=60, nulls=0.05, start="2024-01-01"):
    """Panel with missing days and missing prices, in random row order."""
    rng = np.random.default_rng(seed)
    out = []
    for s in range(symbols):
        px = 100.0
        for day in weekdays(start, rows + 10):
            if rng.random() < 0.1:
                continue
            px *= 1 + rng.normal(0, 0.02)
            close = None if rng.random() < nulls else float(px)
            out.append(
                {
                    "symbol": f"S{s}", "date": day, "open": px, "high": px * 1.01, "low": px * 0.99, "close": close,
                    "adj_close": None if close is None else close * 0.98,
                    "volume": float(rng.integers(0, 5) * 100) or 0.0,
                }
            )
    rng.shuffle(out)
    return out


def frame(spark, rows, schema):
    names = [part.strip().split()[0] for part in schema.split(",")]
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], schema)


def table(df, *keys):
    """Rows as a pandas frame sorted by the keys."""
    return pd.DataFrame([r.asDict() for r in df.collect()], columns=df.columns).sort_values(list(keys)).reset_index(drop=True)


def assert_close(got, want, columns, tol=1e-9):
    assert len(got) == len(want)
    for c in columns:
        a = pd.to_numeric(got[c]).to_numpy(dtype=float)
        b = pd.to_numeric(want[c]).to_numpy(dtype=float)
        np.testing.assert_allclose(a, b, rtol=tol, atol=tol, equal_nan=True, err_msg=c)
