"""Queries over raw price quality, coercion and column choice."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelkiln.functions import columns, dates
from panelkiln.functions.numeric import all_finite, all_present, clip, number
from panelkiln.operators import feature_store, quality, quality_summaries
from panelkiln.plans import adapters as a
from panelkiln.plans import sql_parts as s
from panelkiln.plans.registry import counted, query, rounded
from panelkiln.session import fresh_folder
from panelkiln.sources.tables import with_month, write_table

PRICES = ("open", "high", "low", "close", "adj_close", "volume")


@query(
    "a05_missing_ratios",
    f"""WITH {s.RAW_PRICES}, m AS (SELECT {', '.join(f'avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END) AS missing_{c}' for c in PRICES)} FROM prices)
    SELECT {', '.join(f'round(missing_{c}, 6) + 0.0 AS missing_{c}' for c in PRICES)},
           round(({' + '.join(f'missing_{c}' for c in PRICES)}) / 6, 6) + 0.0 AS missing_ratio_overall FROM m""",
)
def _missing_ratios(spark, sf_dir):
    return rounded(quality.missing_ratios(a.line_prices(spark, sf_dir)))


@query(
    "a06_duplicates",
    f"""WITH {s.RAW_PRICES} SELECT count(*) - count(DISTINCT (date, symbol)) AS duplicates_count,
    round((count(*) - count(DISTINCT (date, symbol))) / count(*), 6) + 0.0 AS duplicates_ratio FROM prices""",
)
def _duplicates(spark, sf_dir):
    return rounded(quality.duplicates(a.line_prices(spark, sf_dir)))


@query(
    "a07_a08_bar_anomalies",
    f"""WITH {s.RAW_PRICES}, f AS (SELECT *, coalesce(open < 0, false) OR coalesce(high < 0, false) OR coalesce(low < 0, false)
      OR coalesce(close < 0, false) OR coalesce(high < low, false) OR coalesce(close < low, false)
      OR coalesce(close > high, false) AS odd FROM
      (SELECT * REPLACE (CASE WHEN volume = 30 THEN -open ELSE open END AS open, CASE WHEN volume = 31 THEN low * 0.9 ELSE high END AS high) FROM prices))
    SELECT count(*) FILTER (odd) AS ohlc_anomaly_rows, round(avg(odd::INT), 6) + 0.0 AS ohlc_anomaly_ratio,
           round(avg(coalesce(volume = 0, false)::INT), 6) + 0.0 AS volume_zero_ratio FROM f""",
)
def _bar_anomalies(spark, sf_dir):
    prices = a.line_prices(spark, sf_dir).withColumns(
        {
            "open": F.when(F.col("volume") == 30, -F.col("open")).otherwise(F.col("open")),
            "high": F.when(F.col("volume") == 31, F.col("low") * 0.9).otherwise(F.col("high")),
        }
    )
    return rounded(quality.bar_anomalies(prices))


@query(
    "a09_idle_streaks",
    f"""WITH {s.RAW_PRICES}, z AS (SELECT symbol, date, close, adj_close, CASE WHEN coalesce(volume, 0) <= 0 THEN 1 ELSE 0 END AS idle FROM prices),
    r AS (SELECT sum(idle) OVER w AS hits, count(*) OVER w AS n FROM z
      WINDOW w AS (PARTITION BY symbol ORDER BY date, close NULLS FIRST, adj_close NULLS FIRST, idle ROWS 4 PRECEDING))
    SELECT count(*) FILTER (hits = 5 AND n = 5) AS zero_volume_streak_violations,
           round(count(*) FILTER (hits = 5 AND n = 5) / count(*), 6) + 0.0 AS zero_volume_streak_violation_ratio FROM r""",
)
def _idle_streaks(spark, sf_dir):
    return rounded(quality.idle_streaks(a.line_prices(spark, sf_dir), length=5))


RAW_MOVES = f"""{s.RAW_PRICES},
padded AS (SELECT symbol, date, close, adj_close,
    last_value(close IGNORE NULLS) OVER w AS c, last_value(adj_close IGNORE NULLS) OVER w AS ac,
    row_number() OVER (PARTITION BY symbol ORDER BY date, close NULLS FIRST, adj_close NULLS FIRST) AS rn
  FROM prices WINDOW w AS (PARTITION BY symbol ORDER BY date, close NULLS FIRST, adj_close NULLS FIRST
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
moves AS (SELECT symbol, date, abs(c / lag(c) OVER w - 1) AS cm, abs(ac / lag(ac) OVER w - 1) AS am
  FROM padded WINDOW w AS (PARTITION BY symbol ORDER BY rn))"""


@query(
    "a10_price_jumps",
    f"""WITH {RAW_MOVES} SELECT round(avg(coalesce(cm > 0.2, false)::INT), 6) + 0.0 AS price_jump_ratio FROM moves""",
)
def _price_jumps(spark, sf_dir):
    return rounded(quality.price_jumps(a.line_prices(spark, sf_dir), threshold=0.2))


@query(
    "a11_thin_symbols",
    f"WITH {s.BARS} SELECT symbol, count(date) AS obs FROM bars GROUP BY symbol HAVING count(date) < 530",
)
def _thin_symbols(spark, sf_dir):
    return quality.thin_symbols(a.landed_bars(spark, sf_dir), min_obs=530)


@query(
    "a11_symbol_totals",
    f"""WITH {s.BARS}, o AS (SELECT symbol, count(date) AS obs FROM bars GROUP BY symbol)
    SELECT count(*) AS symbols_total, count(*) FILTER (obs < 530) AS symbols_excluded_min_obs,
           count(*) FILTER (obs >= 530) AS symbols_after_filter FROM o""",
)
def _symbol_totals(spark, sf_dir):
    return quality.symbol_totals(a.landed_bars(spark, sf_dir), min_obs=530)


def _action_share(line: int, limit: str, name: str) -> str:
    return f"""(SELECT coalesce(avg(coalesce(am > {limit}, false)::INT), 0) FROM moves JOIN
      (SELECT DISTINCT CAST(l_suppkey AS VARCHAR) AS symbol, CAST(l_shipdate AS DATE) AS date FROM lineitem
       WHERE l_returnflag = 'R' AND l_linenumber = {line}) USING (symbol, date)) AS {name}"""


@query(
    "a12_j08_adjustment_violations",
    f"""WITH {RAW_MOVES}, v AS (SELECT {_action_share(2, 'cm * 1.2 + 1e-8', 'sp')}, {_action_share(3, 'cm + 0.03', 'dv')})
    SELECT round(sp, 6) + 0.0 AS split_adjustment_violation_ratio, round(dv, 6) + 0.0 AS dividend_adjustment_violation_ratio FROM v""",
)
def _adjustment_violations(spark, sf_dir):
    return rounded(
        quality.adjustment_violations(
            a.line_prices(spark, sf_dir), a.actions(spark, sf_dir, 2), a.actions(spark, sf_dir, 3)
        )
    )


THRESHOLDS = {"missing_ratio_max": 0.03, "min_obs_per_symbol": 590, "min_symbols_after_filter": 2, "duplicates_ratio_max": 0.01}


@query(
    "a13_quality_gate",
    f"""WITH {RAW_MOVES},
    k AS (SELECT (count(*) - count(DISTINCT (date, symbol))) / count(*) AS dup,
            ({' + '.join(f'avg(({c} IS NULL)::INT)' for c in PRICES)}) / 6 AS missing,
            avg((adj_close IS NULL)::INT) AS adj_missing,
            avg((coalesce(close > high, false) OR coalesce(close < low, false) OR coalesce(high < low, false))::INT) AS odd FROM prices),
    idle AS (SELECT count(*) FILTER (hits = 5 AND n = 5) / count(*) AS streak FROM (
      SELECT sum((coalesce(volume, 0) <= 0)::INT) OVER w AS hits, count(*) OVER w AS n FROM prices
      WINDOW w AS (PARTITION BY symbol ORDER BY date, close NULLS FIRST, adj_close NULLS FIRST, (coalesce(volume, 0) <= 0)::INT ROWS 4 PRECEDING))),
    syms AS (SELECT count(*) FILTER (obs >= 590) AS after_filter FROM (SELECT symbol, count(date) AS obs FROM prices GROUP BY symbol)),
    v AS (SELECT {_action_share(2, 'cm * 1.2 + 1e-8', 'sp')}, {_action_share(3, 'cm + 0.03', 'dv')}),
    reasons AS (SELECT array_to_string(list_filter([
        CASE WHEN missing > 0.03 THEN printf('missing_ratio_overall=%.6f>0.03', missing) END,
        CASE WHEN odd > 0.02 THEN printf('ohlc_anomaly_ratio=%.6f>0.02', odd) END,
        CASE WHEN dup > 0.01 THEN printf('duplicates_ratio=%.6f>0.01', dup) END,
        CASE WHEN streak > 0.02 THEN printf('zero_volume_streak_violation_ratio=%.6f>0.02', streak) END,
        CASE WHEN after_filter < 2 THEN printf('symbols_after_filter=%d<2', after_filter) END,
        CASE WHEN adj_missing > 0.02 OR sp > 0.3 OR dv > 0.3 THEN 'adjusted_consistency_failed' END], lambda x: x IS NOT NULL), '; ') AS reasons
      FROM k, idle, syms, v)
    SELECT reasons = '' AS passed, reasons AS fail_reasons FROM reasons""",
)
def _quality_gate(spark, sf_dir):
    metrics = quality.quality_metrics(
        a.line_prices(spark, sf_dir),
        thresholds=THRESHOLDS,
        adjusted=True,
        splits=a.actions(spark, sf_dir, 2),
        dividends=a.actions(spark, sf_dir, 3),
    )
    gate = quality.quality_gate(metrics, thresholds=THRESHOLDS, adjusted=True)
    return gate.select("passed", F.array_join("fail_reasons", "; ").alias("fail_reasons"))


SUMMARY_FIGURES = {
    "rows": "(SELECT count(*) FROM prices)",
    **{f"missing_{c}": f"(SELECT avg(({c} IS NULL)::INT) FROM prices)" for c in PRICES},
    "missing_ratio_overall": f"(SELECT ({' + '.join(f'avg(({c} IS NULL)::INT)' for c in PRICES)}) / 6 FROM prices)",
    "ohlc_anomaly_rows": "(SELECT count(*) FILTER (odd) FROM bars_seen)",
    "ohlc_anomaly_ratio": "(SELECT avg(odd::INT) FROM bars_seen)",
    "volume_zero_ratio": "(SELECT avg(coalesce(volume = 0, false)::INT) FROM prices)",
    "duplicates_count": "(SELECT count(*) - count(DISTINCT (date, symbol)) FROM prices)",
    "duplicates_ratio": "(SELECT (count(*) - count(DISTINCT (date, symbol))) / count(*) FROM prices)",
    "price_jump_ratio": "(SELECT avg(coalesce(cm > 0.2, false)::INT) FROM moves)",
    "symbols_total": "(SELECT count(*) FROM obs)",
    "symbols_excluded_min_obs": "(SELECT count(*) FILTER (n < 590) FROM obs)",
    "symbols_after_filter": "(SELECT count(*) FILTER (n >= 590) FROM obs)",
    "zero_volume_streak_violations": "(SELECT count(*) FILTER (hits = 5 AND n = 5) FROM streaks)",
    "zero_volume_streak_violation_ratio": "(SELECT count(*) FILTER (hits = 5 AND n = 5) / count(*) FROM streaks)",
}


@query(
    "a13_quality_summaries",
    f"""WITH {RAW_MOVES},
    bars_seen AS (SELECT coalesce(close > high, false) OR coalesce(close < low, false) OR coalesce(high < low, false) AS odd FROM prices),
    obs AS (SELECT symbol, count(date) AS n FROM prices GROUP BY symbol),
    streaks AS (SELECT sum((coalesce(volume, 0) <= 0)::INT) OVER w AS hits, count(*) OVER w AS n FROM prices
      WINDOW w AS (PARTITION BY symbol ORDER BY date, close NULLS FIRST, adj_close NULLS FIRST, (coalesce(volume, 0) <= 0)::INT ROWS 4 PRECEDING))
    {' UNION ALL '.join(f"SELECT '{name}' AS metric, round(({sql})::DOUBLE, 6) + 0.0 AS value" for name, sql in SUMMARY_FIGURES.items())}""",
)
def _quality_summaries(spark, sf_dir):
    """Figures from monthly summaries of a raw table that got its rows in two lots, the second over a few months anew."""
    prices, store = fresh_folder(spark, "raw"), fresh_folder(spark, "quality")
    rows = with_month(a.line_prices(spark, sf_dir))
    late = (F.pmod(F.xxhash64("symbol", "close"), F.lit(3)) == 0) & F.col("month").isin(199504, 199505, 199610) | (F.col("month") >= 199807)
    write_table(rows.where(~late), prices, partition_by="month")
    quality_summaries.refresh_summaries(spark, prices, store)
    write_table(rows.where(late), prices, partition_by="month", mode="append")
    touched = [r[0] for r in rows.where(late).select("month").distinct().collect()]
    quality_summaries.refresh_summaries(spark, prices, store, touched)
    return rounded(quality_summaries.metrics_from_summaries(quality_summaries.stored_summaries(spark, store), thresholds=THRESHOLDS))


@query(
    "p02_p03_coercion",
    """SELECT event_id, try_cast(CASE WHEN event_type = 'error' THEN 'n/a' WHEN event_type = 'view' THEN 'nan' ELSE CAST(value AS VARCHAR) END AS DOUBLE) + 0.0 AS num,
      CASE WHEN event_type IN ('click', 'purchase') THEN CAST(ts AS DATE) END AS day, upper(trim('  ' || event_type || ' ')) AS symbol FROM (
      SELECT * FROM events WHERE event_type <> 'view') UNION ALL
    SELECT event_id, NULL, NULL, upper(trim('  ' || event_type || ' ')) FROM events WHERE event_type = 'view'""",
)
def _coercion(spark, sf_dir):
    """Text to numbers and days, bad text to NULL; symbols trimmed and upper-cased."""
    kind = F.col("event_type")
    raw = a.table(spark, sf_dir, "events").select(
        "event_id",
        F.when(kind == "error", "n/a").when(kind == "view", "nan").otherwise(F.col("value").cast("string")).alias("num"),
        F.when(kind == "error", "not-a-date").when(kind == "signup", "  ").when(kind != "view", F.col("ts").cast("string")).alias("day"),
        F.concat(F.lit("  "), kind, F.lit(" ")).alias("symbol"),
    )
    return raw.select(
        "event_id", number("num").alias("num"), dates.day("day").alias("day"), columns.symbol_name("symbol").alias("symbol")
    )


@query(
    "p05_p06_p07_aliases",
    """SELECT event_id, value AS eps, CAST(ts AS DATE) AS day,
      CASE WHEN event_type IN ('click', 'view') THEN round(least(1.0, greatest(-1.0, value / 10 - 1)), 6) + 0.0 END AS score FROM events""",
)
def _aliases(spark, sf_dir):
    """P5: first present column; P6: first value per row; P7, P15: first column with data, clipped."""
    kind, ts = F.col("event_type"), F.col("ts").cast("string")
    raw = a.table(spark, sf_dir, "events").select(
        "event_id",
        F.col("value").alias("epsActual"),
        (F.col("value") + 1).alias("epsReported"),
        F.when(kind == "click", ts).when(kind == "view", "soon").alias("publishedDate"),
        F.when(kind != "click", ts).otherwise("1999-01-01").alias("date"),
        F.lit(None).cast("string").alias("sentiment"),
        F.when(kind.isin("click", "view"), (F.col("value") / 10 - 1).cast("string")).alias("sentimentScore"),
    )
    eps = columns.first_present(raw, ("eps", "epsActual", "epsReported"))
    when = columns.first_value(raw, ("publishedDate", "published_date", "date"), dates.day, "date")
    scored = columns.first_with_data(raw, ("sentiment", "sentimentScore", "sentiment_score"))
    return rounded(
        raw.select(
            "event_id", F.col(eps).alias("eps"), when.alias("day"), clip(number(scored), -1.0, 1.0).alias("score")
        )
    )


FILTER_SQL = f"""{s.BARS}, {s.features([1, 5])}, {s.labels(5)},
m AS (SELECT decision_date, symbol, CASE WHEN volume_z_20d > 2 THEN 'Infinity'::DOUBLE ELSE volume_z_20d END AS z, ret_5d, vol_20d,
      future_return_5d AS y FROM feats JOIN labels_h USING (decision_date, symbol))"""


@query(
    "p10_training_and_scoring_rows",
    f"""WITH {FILTER_SQL} SELECT count(*) AS n, count(*) FILTER (isfinite(z) AND isfinite(ret_5d) AND isfinite(vol_20d) AND isfinite(y)) AS trainable,
    count(*) FILTER (z IS NOT NULL AND ret_5d IS NOT NULL AND vol_20d IS NOT NULL) AS scorable FROM m""",
)
def _row_filters(spark, sf_dir):
    """Infinities are kept out of training but may be scored."""
    from panelkiln.plans.portfolio_queries import merged_panel

    z = F.col("volume_z_20d")
    merged = merged_panel(spark, sf_dir).withColumn("z", F.when(z > 2, F.lit(float("inf"))).otherwise(z))
    inputs = ["z", "ret_5d", "vol_20d"]
    return merged.agg(
        counted("n"),
        F.count_if(all_finite([*inputs, "future_return_5d"])).alias("trainable"),
        F.count_if(all_present(inputs)).alias("scorable"),
    )


@query(
    "p11_feature_selection",
    f"""WITH {s.BARS}, {s.features([1, 5])} SELECT decision_date, symbol, round(ret_1d, 6) + 0.0 AS ret_1d,
    round(ret_5d, 6) + 0.0 AS ret_5d, round(range_20d, 6) + 0.0 AS range_20d FROM feats""",
)
def _feature_selection(spark, sf_dir):
    from panelkiln.operators.price_features import build_price_features

    features = build_price_features(a.landed_bars(spark, sf_dir), lookbacks=(1, 5))
    names = feature_store.select_features(
        features.columns, "future_return_5d", exclude_prefixes=["vol", "adv"], exclude_patterns=[r"^corr_.*\d+d$"]
    )
    return rounded(features.select("decision_date", "symbol", *names))


@query(
    "p14_date_window",
    f"WITH {s.BARS} SELECT symbol, count(*) AS n FROM bars WHERE date BETWEEN DATE '1996-02-03' AND DATE '1998-07-31' GROUP BY symbol",
)
def _date_window(spark, sf_dir):
    rows = a.landed_bars(spark, sf_dir).filter(F.col("date").between("1996-02-03", "1998-07-31"))
    return rows.groupBy("symbol").agg(counted("n"))


@query(
    "j10_u05_excluded_symbols",
    f"""WITH {s.BARS} SELECT symbol, date, volume FROM bars WHERE symbol NOT IN (
      SELECT symbol FROM bars GROUP BY symbol HAVING count(date) < 530)""",
)
def _excluded_symbols(spark, sf_dir):
    bars = a.landed_bars(spark, sf_dir)
    return feature_store.without_symbols(bars, quality.thin_symbols(bars, 530)).select("symbol", "date", "volume")
