"""Common table expressions for the comparison SQL."""

LINES = """li AS (
  SELECT CAST(l_suppkey AS VARCHAR) AS symbol, CAST(l_shipdate AS DATE) AS date, l_extendedprice / l_quantity AS u,
         l_quantity AS q, l_discount AS d, l_orderkey, l_linenumber, l_returnflag
  FROM lineitem)"""


def bars_from(name: str, source: str, condition: str = "TRUE") -> str:
    order = "ORDER BY l_orderkey, l_linenumber, u"
    return f"""{name} AS (
  SELECT symbol, date, first(u {order}) AS open, max(u) AS high, min(u) AS low, last(u {order}) AS close,
         last(u {order}) * (1 - avg(d)) AS adj_close, sum(q) AS volume
  FROM {source} WHERE {condition} GROUP BY symbol, date)"""


BARS = f"{LINES}, {bars_from('bars', 'li')}"

EVENT_BARS = """bars AS (
  SELECT 'U' || user_id AS symbol, CAST(ts AS DATE) AS date, first(value ORDER BY ts, event_id) AS open,
         max(value) AS high, min(value) AS low, last(value ORDER BY ts, event_id) AS close,
         last(value ORDER BY ts, event_id) AS adj_close, CAST(count(*) AS DOUBLE) AS volume
  FROM events GROUP BY 1, 2)"""

RAW_PRICES = f"""{LINES}, prices AS (
  SELECT symbol, date, u * (1 - d) AS open, CASE WHEN q <= 45 THEN u END AS high, u * 0.95 AS low,
         CASE WHEN q > 1 THEN u END AS close, CASE WHEN q > 2 THEN u * (1 - d) END AS adj_close,
         CASE WHEN q <= 25 THEN 0.0 WHEN q < 50 THEN q END AS volume
  FROM li)"""


def features(lookbacks: list[int]) -> str:
    """Price features from ``bars``: each figure at its own row first, then lagged one row."""
    rets = ", ".join(f"close / nullif(lag(close, {k}) OVER w, 0) - 1 AS r{k}" for k in lookbacks)
    lagged = ", ".join(f"lag(r{k}) OVER w AS ret_{k}d" for k in lookbacks)
    mom = ", lag(r20) OVER w - lag(r60) OVER w AS mom_20_60" if {20, 60} <= set(lookbacks) else ""
    return f"""market AS (SELECT date, avg(close) AS mkt_px FROM bars GROUP BY date),
f0 AS (
  SELECT b.*, {rets}, close / nullif(lag(close) OVER w, 0) - 1 AS raw, lag(mkt_px, 1) OVER w / nullif(lag(mkt_px, 2) OVER w, 0) - 1 AS mr,
         lag(date) OVER w AS available
  FROM bars b JOIN market m USING (date) WINDOW w AS (PARTITION BY symbol ORDER BY date)),
f1 AS (
  SELECT *, CASE WHEN raw > -1 THEN ln(raw + 1) END AS lr, (high - low) / nullif(close, 0) AS rg,
         nullif(volume, 0) * close AS dollar, nullif(volume, 0) AS vol,
         CASE WHEN mr IS NOT NULL THEN raw END AS px, CASE WHEN raw IS NOT NULL THEN mr END AS mx
  FROM f0),
f2 AS (
  SELECT *,
    CASE WHEN count(px) OVER t >= 20 THEN covar_pop(px, mx) OVER t
         / nullif(stddev_pop(px) OVER t * stddev_pop(mx) OVER t, 0) END AS corr20,
    CASE WHEN count(lr) OVER t >= 20 THEN stddev_samp(lr) OVER t END AS vol20,
    CASE WHEN count(rg) OVER t >= 20 THEN avg(rg) OVER t END AS range20,
    CASE WHEN count(dollar) OVER t >= 20 THEN avg(dollar) OVER t END AS adv20,
    CASE WHEN count(vol) OVER t >= 20 THEN (vol - avg(vol) OVER t) / (stddev_samp(vol) OVER t + 1e-12) END AS z20
  FROM f1 WINDOW t AS (PARTITION BY symbol ORDER BY date ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)),
feats AS (
  SELECT * FROM (
    SELECT date AS decision_date, symbol, {lagged}, lag(corr20) OVER w AS corr_mkt_20d, lag(vol20) OVER w AS vol_20d,
           lag(range20) OVER w AS range_20d, lag(adv20) OVER w AS adv20_dollar, lag(z20) OVER w AS volume_z_20d{mom},
           available AS feature_available_date
    FROM f2 WINDOW w AS (PARTITION BY symbol ORDER BY date))
  WHERE feature_available_date IS NOT NULL)"""


def labels(horizon: int, name: str = "labels_h", source: str = "bars") -> str:
    return f"""{name} AS (
  SELECT * FROM (
    SELECT date AS decision_date, lead(date, {horizon}) OVER w AS label_date, symbol,
           lead(close, {horizon}) OVER w / nullif(close, 0) - 1 AS future_return_{horizon}d, {horizon} AS horizon
    FROM {source} WINDOW w AS (PARTITION BY symbol ORDER BY date))
  WHERE label_date IS NOT NULL AND future_return_{horizon}d IS NOT NULL)"""


def bday(day: str, n: int) -> str:
    """``n >= 1`` business days after ``day``, found by walking the calendar."""
    reach = n + 2 * (n // 5 + 1) + 2
    walk = f"generate_series({day} + INTERVAL 1 DAY, {day} + INTERVAL {reach} DAY, INTERVAL 1 DAY)"
    return f"CAST([x FOR x IN {walk} IF isodow(x) < 6][{n}] AS DATE)"


PREDICTIONS = f"""{BARS}, {features([5])}, {labels(1)},
preds AS (
  SELECT decision_date, symbol, -ret_5d AS y_pred, ln(1 + future_return_1d) / 100 AS y_true, adv20_dollar, vol_20d
  FROM feats JOIN labels_h USING (decision_date, symbol))"""
