"""Queries over folds, audits, prediction quality, portfolios and sweeps."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelkiln.functions.numeric import log
from panelkiln.operators import audit, folds, labels, metrics, portfolio, portfolio_grid, price_features, sweep
from panelkiln.operators.rows import top_rows
from panelkiln.plans import adapters as a
from panelkiln.plans import sql_parts as s
from panelkiln.plans.registry import counted, query, rounded
from panelkiln.session import stored


def merged_panel(spark, sf_dir, lookbacks=(1, 5), horizon=5):
    """Features with their labels, taken in one pass over each symbol."""
    return price_features.build_price_features(
        a.landed_bars(spark, sf_dir), lookbacks=lookbacks, label_horizon=horizon
    )


def predictions(spark, sf_dir):
    """Short-term reversal as the score, the next row's move as the outcome.

    Test prices change by multiples from row to row, so the move is damped: a
    hundredth of its log keeps the equity curve finite.
    """
    merged = merged_panel(spark, sf_dir, (5,), 1)
    return merged.select(
        "decision_date", "symbol", (-F.col("ret_5d")).alias("y_pred"), (F.log1p("future_return_1d") / 100.0).alias("y_true"),
        "adv20_dollar", "vol_20d",
    )


def stored_predictions(spark, sf_dir):
    """Predictions as a table: a portfolio looks at them several times."""
    return stored(predictions(spark, sf_dir), "predictions")


# --- folds --------------------------------------------------------------------------------------

DAYS_SQL = """days AS (SELECT date, row_number() OVER (ORDER BY date) - 1 AS pos FROM (
  SELECT DISTINCT CAST(l_shipdate AS DATE) AS date FROM lineitem))"""
SIZES = {"train": 504, "val": 126, "test": 126}
FOLDS_SQL = f"""{DAYS_SQL},
starts AS (SELECT CAST(range AS INT) AS fold, range * 63 AS first FROM range(0, 1000)
  WHERE range * 63 + 756 <= (SELECT count(*) FROM days)),
folds AS (SELECT fold, CASE WHEN pos - first < 504 THEN 'train' WHEN pos - first < 630 THEN 'val' ELSE 'test' END AS part, date,
  CAST(pos - first - CASE WHEN pos - first < 504 THEN 0 WHEN pos - first < 630 THEN 504 ELSE 630 END AS INT) AS part_pos
  FROM days JOIN starts ON pos >= first AND pos < first + 756),
purged AS (SELECT * FROM folds WHERE (part = 'train' AND part_pos < 484) OR (part = 'val' AND part_pos >= 5 AND part_pos < 106)
  OR (part = 'test' AND part_pos >= 5))"""


def _line_days(spark, sf_dir):
    lines = a.table(spark, sf_dir, "lineitem").select(F.to_date("l_shipdate").alias("decision_date"))
    return folds.trading_days(lines)


def all_folds(spark, sf_dir):
    return folds.walk_forward(_line_days(spark, sf_dir), **SIZES, step=63)


def purged_folds(spark, sf_dir):
    return folds.purge_and_embargo(all_folds(spark, sf_dir), train=504, val=126, purge=20, embargo=5)


@query("w20_walk_forward", f"WITH {FOLDS_SQL} SELECT fold, part, date, part_pos FROM folds")
def _walk_forward(spark, sf_dir):
    return all_folds(spark, sf_dir)


@query("w21_purge_embargo", f"WITH {FOLDS_SQL} SELECT fold, part, date, part_pos FROM purged")
def _purge_embargo(spark, sf_dir):
    return purged_folds(spark, sf_dir)


@query(
    "w22_fold_order",
    f"""WITH {FOLDS_SQL} SELECT fold, coalesce(max(date) FILTER (part = 'train') < min(date) FILTER (part = 'val')
      AND max(date) FILTER (part = 'val') < min(date) FILTER (part = 'test'), false) AS ok FROM purged GROUP BY fold""",
)
def _fold_order(spark, sf_dir):
    return folds.fold_order(purged_folds(spark, sf_dir))


@query(
    "w23_fold_windows",
    f'WITH {FOLDS_SQL} SELECT fold, part, min(date) AS start, max(date) AS "end", count(*) AS days FROM purged GROUP BY ALL',
)
def _fold_windows(spark, sf_dir):
    return folds.fold_windows(purged_folds(spark, sf_dir))


LAST_FOLD_SQL = f"{FOLDS_SQL}, fold1 AS (SELECT * FROM purged WHERE fold = (SELECT max(fold) FROM purged))"


@query(
    "j09_t06_rows_of_last_fold",
    f"""WITH {LAST_FOLD_SQL}, {s.BARS} SELECT b.symbol, f.part AS split, count(*) AS n, sum(volume) AS volume
    FROM bars b JOIN fold1 f USING (date) GROUP BY ALL""",
)
def _rows_of_last_fold(spark, sf_dir):
    fold = folds.last_fold(purged_folds(spark, sf_dir))
    tagged = folds.tag_parts(a.landed_bars(spark, sf_dir), fold, on="date")
    return tagged.groupBy("symbol", "split").agg(counted("n"), F.sum("volume").alias("volume"))


@query(
    "a23_u04_shared_days",
    f"""WITH {FOLDS_SQL} SELECT count(*) AS overlap FROM (
      SELECT date FROM folds WHERE part = 'train' INTERSECT SELECT date FROM folds WHERE part = 'test')""",
)
def _shared_days(spark, sf_dir):
    """Train and test days shared between different folds (within one fold there are none)."""
    return audit.shared_days(all_folds(spark, sf_dir))


# --- audits -------------------------------------------------------------------------------------

MERGED_SQL = f"""{s.BARS}, {s.features([1, 5])}, {s.labels(5)},
merged AS (SELECT * FROM feats JOIN labels_h USING (decision_date, symbol))"""


@query(
    "a24_label_and_feature_audit",
    f"""WITH {MERGED_SQL}
    SELECT 'labels' AS source, count(*) FILTER (label_date <= decision_date) AS bad_rows, count(*) FILTER (label_date <= decision_date) = 0 AS ok, '' AS message FROM labels_h
    UNION ALL SELECT 'features', count(*) FILTER (feature_available_date >= decision_date), count(*) FILTER (feature_available_date >= decision_date) = 0, '' FROM feats
    UNION ALL SELECT 'late_features', count(*), false, 'feature_available_date_not_before_decision_date rows=' || count(*) FROM feats""",
)
def _date_audits(spark, sf_dir):
    bars = a.landed_bars(spark, sf_dir)
    features = price_features.build_price_features(bars, lookbacks=(1,))
    late = features.withColumn("feature_available_date", F.col("decision_date"))
    parts = {
        "labels": audit.label_audit(labels.build_labels(bars, horizon=5)),
        "features": audit.feature_audit(features),
        "late_features": audit.feature_audit(late),
    }
    rows = [df.select(F.lit(name).alias("source"), "bad_rows", "ok", "message") for name, df in parts.items()]
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


AUDITED = ["ret_1d", "ret_5d", "corr_mkt_20d", "vol_20d", "range_20d", "adv20_dollar", "volume_z_20d"]


@query(
    "a22_feature_target_correlation",
    f"WITH {MERGED_SQL} "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS feature, count(*) AS pairs, round(corr({c}, future_return_5d), 6) + 0.0 AS corr FROM merged WHERE {c} IS NOT NULL"
        for c in AUDITED
    ),
)
def _feature_target_correlation(spark, sf_dir):
    return rounded(audit.feature_correlations(merged_panel(spark, sf_dir), AUDITED, "future_return_5d"))


@query(
    "a25_leakage_gate",
    f"""WITH {LAST_FOLD_SQL}, {MERGED_SQL}, leak AS (
      SELECT corr(2 * future_return_5d + 1, future_return_5d) AS r, count(*) AS n FROM merged JOIN fold1 ON decision_date = date WHERE part = 'train')
    SELECT false AS passed, printf('suspicious_feature_corr: leak:corr=%.4f', r) AS messages, 'leak:corr=' || printf('%.4f', r) AS suspicious,
      'corr_threshold_pass=false,feature_audit=true,label_audit=true,split_no_overlap=true,train_test_date_overlap_zero=true' AS critical FROM leak""",
)
def _leakage_gate(spark, sf_dir):
    """A feature that is the target in disguise must fail the gate."""
    merged = stored(merged_panel(spark, sf_dir)).withColumn("leak", F.col("future_return_5d") * 2 + 1)
    gate = audit.leakage_gate(
        features=merged,
        labels=merged,
        merged=merged,
        fold=folds.last_fold(purged_folds(spark, sf_dir)),
        feature_names=[*AUDITED, "leak"],
        target="future_return_5d",
    )
    entries = F.transform(
        F.map_entries("critical"), lambda e: F.concat_ws("=", e["key"], e["value"].cast("string"))
    )
    return gate.select(
        "passed",
        F.array_join("messages", "; ").alias("messages"),
        F.array_join("suspicious", "; ").alias("suspicious"),
        F.array_join(entries, ",").alias("critical"),
    )


# --- prediction quality -------------------------------------------------------------------------

IC_SQL = f"""{s.PREDICTIONS},
usable AS (SELECT decision_date, symbol, y_pred, y_true FROM preds WHERE y_pred IS NOT NULL AND y_true IS NOT NULL),
ranked AS (SELECT decision_date,
    rank() OVER (PARTITION BY decision_date ORDER BY y_pred) + (count(*) OVER (PARTITION BY decision_date, y_pred) - 1) / 2.0 AS rp,
    rank() OVER (PARTITION BY decision_date ORDER BY y_true) + (count(*) OVER (PARTITION BY decision_date, y_true) - 1) / 2.0 AS rt,
    y_pred, y_true FROM usable),
ic AS (SELECT decision_date, count(*) AS n, corr(y_pred, y_true) AS ic FROM ranked GROUP BY 1 HAVING count(*) >= 3 AND isfinite(corr(y_pred, y_true))),
rank_ic AS (SELECT decision_date, count(*) AS n, corr(rp, rt) AS ic FROM ranked GROUP BY 1 HAVING count(*) >= 3 AND isfinite(corr(rp, rt)))"""


@query("a15_daily_ic", f"WITH {IC_SQL} SELECT decision_date, n, round(ic, 6) + 0.0 AS ic FROM ic")
def _daily_ic(spark, sf_dir):
    return rounded(metrics.daily_ic(predictions(spark, sf_dir)))


@query("a16_daily_rank_ic", f"WITH {IC_SQL} SELECT decision_date, n, round(ic, 6) + 0.0 AS ic FROM rank_ic")
def _daily_rank_ic(spark, sf_dir):
    return rounded(metrics.daily_rank_ic(predictions(spark, sf_dir)))


@query(
    "a16_rank_ic_with_ties",
    """WITH r AS (SELECT CAST(o_orderdate AS DATE) AS decision_date,
      rank() OVER (PARTITION BY CAST(o_orderdate AS DATE) ORDER BY o_custkey % 3) + (count(*) OVER (PARTITION BY CAST(o_orderdate AS DATE), o_custkey % 3) - 1) / 2.0 AS a,
      rank() OVER (PARTITION BY CAST(o_orderdate AS DATE) ORDER BY floor(o_totalprice / 100000)) + (count(*) OVER (PARTITION BY CAST(o_orderdate AS DATE), floor(o_totalprice / 100000)) - 1) / 2.0 AS b FROM orders)
    SELECT decision_date, count(*) AS n, round(covar_pop(a, b) / (stddev_pop(a) * stddev_pop(b)), 6) + 0.0 AS ic FROM r
    GROUP BY 1 HAVING count(*) >= 3 AND stddev_pop(a) > 0 AND stddev_pop(b) > 0""",
)
def _rank_ic_with_ties(spark, sf_dir):
    scored = a.table(spark, sf_dir, "orders").select(
        F.to_date("o_orderdate").alias("decision_date"),
        (F.col("o_custkey") % 3).alias("y_pred"),
        F.floor(F.col("o_totalprice") / 100000).alias("y_true"),
    )
    return rounded(metrics.daily_rank_ic(scored))


@query(
    "a17_a18_evaluation",
    f"""WITH {LAST_FOLD_SQL}, {IC_SQL}, both_ic AS (SELECT 'ic' AS kind, * FROM ic UNION ALL SELECT 'rank_ic', * FROM rank_ic)
    SELECT 'reversal' AS model_name, part AS split, kind, count(*) AS n, round(avg(ic), 6) + 0.0 AS mean,
      round(CASE WHEN count(*) > 1 THEN stddev_samp(ic) ELSE 0.0 END, 6) + 0.0 AS std, len(list(ic)) AS days
    FROM both_ic JOIN fold1 ON decision_date = date GROUP BY part, kind""",
)
def _evaluation(spark, sf_dir):
    fold = folds.last_fold(purged_folds(spark, sf_dir))
    # Stored once for both figures, and only what they read: days of the fold, scores and outcomes.
    tagged = folds.tag_parts(predictions(spark, sf_dir), fold).select("decision_date", "split", "y_pred", "y_true")
    preds = stored(tagged, "predictions").withColumn("model_name", F.lit("reversal"))
    table = metrics.evaluate_predictions(preds).withColumn("days", F.size("daily").cast("long")).drop("daily")
    return rounded(table)


@query(
    "a26_mean_squared_error",
    f"WITH {s.PREDICTIONS} SELECT round(avg((y_pred - y_true) ** 2), 6) + 0.0 AS mse FROM preds",
)
def _mean_squared_error(spark, sf_dir):
    return rounded(metrics.mean_squared_error(predictions(spark, sf_dir)))


@query(
    "a19_a20_return_series",
    """WITH d AS (SELECT CAST(o_orderdate AS DATE) AS date, avg(o_totalprice) / 250000 - 1.0 AS net_return FROM orders GROUP BY 1),
    n AS (SELECT date, net_return / 50 AS net_return FROM d),
    e AS (SELECT *, exp(sum(ln(1 + net_return)) OVER (ORDER BY date)) AS equity FROM n),
    p AS (SELECT *, equity / max(equity) OVER (ORDER BY date) - 1 AS drawdown FROM e)
    SELECT round(avg(net_return) / stddev_samp(net_return) * sqrt(252), 6) + 0.0 AS sharpe, round(min(drawdown), 6) + 0.0 AS max_drawdown,
      round(ln(arg_max(equity, date)), 6) + 0.0 AS log_equity, count(*) AS n, round(avg(net_return), 6) + 0.0 AS mean, round(stddev_samp(net_return), 6) + 0.0 AS std FROM p""",
)
def _return_series(spark, sf_dir):
    daily = (
        a.table(spark, sf_dir, "orders")
        .groupBy(F.to_date("o_orderdate").alias("date"))
        .agg(((F.avg("o_totalprice") / 250000 - 1.0) / 50).alias("net_return"))
    )
    return rounded(
        metrics.with_drawdown(daily).agg(
            metrics.sharpe("net_return").alias("sharpe"),
            F.min("drawdown").alias("max_drawdown"),
            F.ln(F.max_by("equity", "date")).alias("log_equity"),
            *metrics.series_summary("net_return"),
        )
    )


@query(
    "w17_t02_top_and_bottom_names",
    f"""WITH {s.PREDICTIONS}, r AS (SELECT decision_date, symbol, y_pred,
      row_number() OVER (PARTITION BY decision_date ORDER BY y_pred DESC, symbol) AS top,
      row_number() OVER (PARTITION BY decision_date ORDER BY y_pred, symbol DESC) AS bottom FROM preds WHERE y_pred IS NOT NULL)
    SELECT 'long' AS side, decision_date, symbol, CAST(top AS INT) AS rn FROM r WHERE top <= 3
    UNION ALL SELECT 'short', decision_date, symbol, CAST(bottom AS INT) FROM r WHERE bottom <= 3""",
)
def _top_and_bottom(spark, sf_dir):
    preds = predictions(spark, sf_dir).filter(F.col("y_pred").isNotNull()).select("decision_date", "symbol", "y_pred")
    preds = stored(preds, "predictions")  # read from both ends
    salt = F.col("symbol")
    longs = top_rows(preds, "decision_date", [F.col("y_pred").desc(), F.col("symbol")], 3, salt)
    shorts = top_rows(preds, "decision_date", [F.col("y_pred"), F.col("symbol").desc()], 3, salt)
    both = longs.withColumn("side", F.lit("long")).unionByName(shorts.withColumn("side", F.lit("short")))
    return both.select("side", "decision_date", "symbol", "rn")


# --- portfolios ---------------------------------------------------------------------------------


def portfolio_sql(topn: int, max_names: int, long_short: bool, cap: float, weekly: bool) -> str:
    """The backtest as row-level SQL: weights per day, previous weights found by lookup."""
    token = "isoyear(date) * 100 + week(date)"
    rebalances = f"row_number() OVER (PARTITION BY {token} ORDER BY date) = 1" if weekly else "true"
    n_long = f"least({topn}, {max_names}, names)"
    n_short = f"least({topn}, {max_names} - {n_long}, names - {n_long})" if long_short else "0"
    if long_short:
        gross = f"({n_long} * least(1.0 / {n_long}, {cap}) + n_short * CASE WHEN n_short > 0 THEN least(1.0 / n_short, {cap}) ELSE 0 END)"
        weight = f"CASE WHEN top <= {n_long} THEN least(1.0 / {n_long}, {cap}) ELSE -least(1.0 / n_short, {cap}) END / {gross}"
    else:
        weight = f"1.0 / {n_long}"
    return f"""{s.PREDICTIONS},
usable AS (SELECT decision_date AS date, symbol, y_pred, y_true, adv20_dollar AS adv, vol_20d AS vol FROM preds WHERE y_pred IS NOT NULL AND y_true IS NOT NULL),
flags AS (SELECT date, names, {rebalances} AS rebalances FROM (SELECT date, count(*) AS names FROM usable GROUP BY date)),
cal AS (SELECT *, count(*) FILTER (rebalances) OVER (ORDER BY date) AS turn FROM flags),
ranked AS (SELECT u.*, names, turn, {n_short} AS n_short,
    row_number() OVER (PARTITION BY date ORDER BY y_pred DESC, symbol) AS top,
    row_number() OVER (PARTITION BY date ORDER BY y_pred, symbol DESC) AS bottom
  FROM usable u JOIN cal USING (date) WHERE rebalances),
target AS (SELECT date, turn, symbol, ({weight})::DOUBLE AS weight, adv, vol FROM ranked WHERE top <= {n_long} OR bottom <= n_short),
change AS (SELECT coalesce(n.turn, p.turn + 1) AS turn, n.symbol IS NOT NULL AS held, abs(coalesce(n.weight, 0) - coalesce(p.weight, 0)) AS dw, n.adv
  FROM target n FULL OUTER JOIN target p ON n.symbol = p.symbol AND n.turn = p.turn + 1),
traded AS (SELECT turn, sum(dw) / 2 AS turnover, avg(dw * 1e6 / coalesce(nullif(adv, 0), 1e12)) FILTER (held) AS impact_adv, count(*) FILTER (held) AS held
  FROM change GROUP BY turn),
pos AS (SELECT u.date, u.symbol, t.weight, u.y_pred, u.y_true, u.vol FROM usable u JOIN cal c USING (date) JOIN target t ON t.turn = c.turn AND t.symbol = u.symbol),
day AS (SELECT p.date, sum(weight * y_true) AS gross_return, count(*) AS n_names, sum(coalesce(vol, 0)) AS vol_sum FROM pos p GROUP BY p.date),
cost AS (SELECT d.date, gross_return, n_names, CASE WHEN rebalances THEN turnover ELSE 0 END AS turnover,
    1.0 + 10.0 * CASE WHEN rebalances THEN impact_adv ELSE 0 END + 1.0 * vol_sum / held AS slip_bps_est
  FROM day d JOIN cal USING (date) JOIN traded USING (turn)),
net AS (SELECT *, turnover / 1e4 AS commission, slip_bps_est / 1e4 * turnover AS slippage FROM cost),
curve AS (SELECT *, commission + slippage AS cost_total, gross_return - commission - slippage AS net_return FROM net),
logs AS (SELECT *, sum(ln(1 + net_return)) OVER (ORDER BY date) AS log_equity FROM curve),
daily AS (SELECT *, exp(log_equity - max(log_equity) OVER (ORDER BY date)) - 1 AS drawdown FROM logs)"""


DAILY_COLUMNS = (
    "date, n_names, "
    + ", ".join(
        f"round({c}, 6) + 0.0 AS {c}"
        for c in ("gross_return", "net_return", "turnover", "log_equity", "drawdown")
    )
    + ", "
    + "round(slip_bps_est, 9) + 0.0 AS slip_bps_est, round(commission * 1e4, 6) + 0.0 AS commission_bps, "
    + ", ".join(f"CASE WHEN {c} > 0 THEN round(ln({c}), 6) + 0.0 END AS ln_{c}" for c in ("slippage", "cost_total"))
)


def _daily(spark, sf_dir, rules):
    daily, _ = portfolio.run_portfolio(stored_predictions(spark, sf_dir), rules)
    return _shown_daily(daily)


def _shown_daily(daily):
    # Costs are fractions of round numbers, so they sit on rounding ties; their logs do not.
    shown = daily.withColumns(
        {
            "log_equity": F.ln("equity"),
            "commission_bps": F.col("commission") * 1e4,
            "ln_slippage": log(F.col("slippage")),
            "ln_cost_total": log(F.col("cost_total")),
        }
    )
    return rounded(shown.drop("equity", "commission", "slippage", "cost_total"), slip_bps_est=9)


LONG_ONLY = portfolio.PortfolioRules(topn=5, max_names=5)
LONG_SHORT = portfolio.PortfolioRules(topn=4, max_names=7, long_short=True, single_name_cap=0.2, rebalance="weekly")


@query("b01_b09_daily_long_only", f"WITH {portfolio_sql(5, 5, False, 0.05, False)} SELECT {DAILY_COLUMNS} FROM daily")
def _daily_long_only(spark, sf_dir):
    return _daily(spark, sf_dir, LONG_ONLY)


@query("b01_b09_weekly_long_short", f"WITH {portfolio_sql(4, 7, True, 0.2, True)} SELECT {DAILY_COLUMNS} FROM daily")
def _weekly_long_short(spark, sf_dir):
    return _daily(spark, sf_dir, LONG_SHORT)


@query(
    "b01_b09_grid_of_rules",
    f"""SELECT 'daily' AS rule, * FROM (WITH {portfolio_sql(5, 5, False, 0.05, False)} SELECT {DAILY_COLUMNS} FROM daily)
    UNION ALL SELECT 'weekly', * FROM (WITH {portfolio_sql(4, 7, True, 0.2, True)} SELECT {DAILY_COLUMNS} FROM daily)
    UNION ALL SELECT 'few', * FROM (WITH {portfolio_sql(2, 5, False, 0.05, True)} SELECT {DAILY_COLUMNS} FROM daily)""",
)
def _grid_of_rules(spark, sf_dir):
    """B1 to B9 for several rules in one plan."""
    rules = {"daily": LONG_ONLY, "weekly": LONG_SHORT, "few": portfolio.PortfolioRules(topn=2, max_names=5, rebalance="weekly")}
    return _shown_daily(portfolio_grid.run_portfolio_grid(stored_predictions(spark, sf_dir), rules))


@query(
    "b03_j11_weekly_positions",
    f"WITH {portfolio_sql(4, 7, True, 0.2, True)} SELECT date, symbol, round(weight, 6) + 0.0 AS weight, round(y_pred, 6) + 0.0 AS y_pred, round(y_true, 6) + 0.0 AS y_true FROM pos",
)
def _weekly_positions(spark, sf_dir):
    _, positions = portfolio.run_portfolio(stored_predictions(spark, sf_dir), LONG_SHORT)
    return rounded(positions)


@query(
    "b05_j12_turnover",
    f"WITH {portfolio_sql(4, 7, True, 0.2, True)} SELECT turn, round(turnover, 6) + 0.0 AS turnover, held, round(coalesce(impact_adv, 0), 6) + 0.0 AS impact_adv FROM traded",
)
def _turnover(spark, sf_dir):
    """Includes the unwinding after the last rebalance."""
    rows = portfolio.usable_predictions(stored_predictions(spark, sf_dir))
    days = portfolio.schedule(rows, "weekly")
    return rounded(portfolio.trades(portfolio.target_positions(rows, days, LONG_SHORT), LONG_SHORT))


SUMMARY_SQL = """SELECT count(*) AS days, round(avg(net_return) / stddev_samp(net_return) * sqrt(252), 6) + 0.0 AS sharpe,
  round(min(drawdown), 6) + 0.0 AS max_drawdown, round(avg(turnover), 6) + 0.0 AS avg_turnover, round(ln(avg(cost_total)), 6) + 0.0 AS ln_avg_cost,
  round(arg_max(log_equity, date), 6) + 0.0 AS log_return FROM daily"""


@query("a21_portfolio_summary", f"WITH {portfolio_sql(5, 5, False, 0.05, False)} {SUMMARY_SQL}")
def _portfolio_summary(spark, sf_dir):
    daily, _ = portfolio.run_portfolio(stored_predictions(spark, sf_dir), LONG_ONLY)
    row = portfolio.portfolio_summary(daily)
    shown = row.withColumns({"log_return": F.log1p("total_return"), "ln_avg_cost": F.ln("avg_cost")})
    return rounded(shown.drop("total_return", "avg_cost"))


# --- sweeps -------------------------------------------------------------------------------------

RUNS_SQL = """runs AS (
  SELECT CAST(year(o_orderdate) AS VARCHAR) AS end_date, o_orderpriority || '/' || o_orderstatus AS name, o_orderkey AS seq,
    CASE WHEN o_totalprice > 20000 THEN o_totalprice / 1000 END AS score, o_totalprice / 1000000 AS rank_ic_test_mean,
    o_totalprice / 100000 AS sharpe, o_totalprice / 200000 - 1 AS total_return, -o_totalprice / 500000 AS max_drawdown,
    CASE WHEN o_totalprice > 5000 THEN o_totalprice / 10000000 END AS avg_cost, o_totalprice > 1500 AS ops_gate_ok,
    [CAST(o_custkey % 7 AS INT), 20] AS lookbacks, CASE WHEN o_orderstatus <> 'P' THEN 1 ELSE 2 END AS event_shift
  FROM orders),
best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY end_date, name ORDER BY score DESC NULLS LAST, seq) AS rn FROM runs) WHERE rn = 1),
agg AS (SELECT name, count(*) AS periods, count(*) FILTER (ops_gate_ok) AS gate_pass_periods, avg(score) AS score_mean, min(score) AS score_min,
    avg(rank_ic_test_mean) AS rank_ic_mean, avg(sharpe) AS sharpe_mean, avg(total_return) AS total_return_mean, avg(max_drawdown) AS max_drawdown_mean,
    array_to_string(arg_min(lookbacks, seq), ',') AS lookbacks, arg_min(event_shift, seq) AS event_shift,
    bool_and(ops_gate_ok) AND count(*) = (SELECT count(DISTINCT end_date) FROM runs) AS all_periods_gate_pass FROM {src} GROUP BY name)"""


def _agg_columns() -> str:
    plain = "name, periods, gate_pass_periods, all_periods_gate_pass, lookbacks, event_shift"
    means = ("score_mean", "score_min", "rank_ic_mean", "sharpe_mean", "total_return_mean", "max_drawdown_mean")
    return plain + ", " + ", ".join(f"round({c}, 6) + 0.0 AS {c}" for c in means)


def _shown(summary):
    return rounded(summary.withColumn("lookbacks", F.array_join("lookbacks", ",")))


@query(
    "a28_best_reruns",
    f"WITH {RUNS_SQL.replace('{src}', 'best')} SELECT end_date, name, seq, score, ops_gate_ok FROM best",
)
def _best_reruns(spark, sf_dir):
    return sweep.best_reruns(a.runs(spark, sf_dir), "seq").select("end_date", "name", "seq", "score", "ops_gate_ok")


@query("a29_run_summary", f"WITH {RUNS_SQL.replace('{src}', 'runs')} SELECT {_agg_columns()} FROM agg")
def _run_summary(spark, sf_dir):
    return _shown(sweep.summarize_runs(a.runs(spark, sf_dir), "seq", settings=("lookbacks", "event_shift")))


@query(
    "t04_best_candidate",
    f"""WITH {RUNS_SQL.replace('{src}', 'best')} SELECT {_agg_columns()} FROM agg
    ORDER BY agg.all_periods_gate_pass DESC, agg.score_mean DESC NULLS LAST, agg.score_min DESC NULLS LAST, agg.name LIMIT 1""",
)
def _best_candidate(spark, sf_dir):
    merged = sweep.best_reruns(a.runs(spark, sf_dir), "seq")
    summary = sweep.summarize_runs(merged, "seq", settings=("lookbacks", "event_shift"))
    return _shown(sweep.best_candidate(summary))


@query(
    "a30_candidate_scores",
    f"""WITH {RUNS_SQL.replace('{src}', 'runs')} SELECT seq,
      round(coalesce(ic, -1) * 120 + sharpe * 1.2 + total_return * 0.05 + coalesce(dd, -1) * 4, 11) + 0.0 AS stability,
      round(coalesce(ic, -1) * 100 + sharpe * 0.5 + total_return * 10 + coalesce(dd, -1) * 2, 11) + 0.0 AS model_smoke,
      round(coalesce(ic, -1) * 100 + sharpe * 0.2 + total_return * 0.001, 11) + 0.0 AS feature_smoke
    FROM (SELECT *, CASE WHEN score > 100 THEN rank_ic_test_mean END AS ic, CASE WHEN score > 200 THEN max_drawdown END AS dd FROM runs)""",
)
def _candidate_scores(spark, sf_dir):
    known = F.col("score")
    rows = a.runs(spark, sf_dir).withColumns(
        {
            "rank_ic": F.when(known > 100, F.col("rank_ic_test_mean")),
            "max_drawdown": F.when(known > 200, F.col("max_drawdown")),
        }
    )
    return rounded(
        rows.select(
            "seq",
            sweep.candidate_score().alias("stability"),
            sweep.candidate_score(sweep.MODEL_SMOKE_WEIGHTS).alias("model_smoke"),
            sweep.candidate_score(sweep.FEATURE_SMOKE_WEIGHTS).alias("feature_smoke"),
        ),
        11,
    )


GATE_SQL = f"""{RUNS_SQL.replace('{src}', 'runs')}, gated AS (SELECT *, array_to_string([x FOR x IN [
    CASE WHEN NOT coalesce(sharpe >= 0.5, false) THEN 'min_sharpe value=' || printf('%.9f', sharpe) || ' required>=0.5' END,
    CASE WHEN NOT coalesce(total_return >= -0.25, false) THEN 'min_total_return value=' || printf('%.9f', total_return) || ' required>=-0.25' END,
    CASE WHEN NOT coalesce(max_drawdown >= -0.45, false) THEN 'min_max_drawdown value=' || printf('%.9f', max_drawdown) || ' required>=-0.45' END,
    CASE WHEN NOT coalesce(avg_cost <= 0.03, false) THEN 'max_avg_cost value=' || coalesce(printf('%.9f', avg_cost), 'none') || ' required<=0.03' END
  ] IF x IS NOT NULL], '; ') AS violations FROM runs)"""


@query("a31_run_gate", f"WITH {GATE_SQL} SELECT seq, violations = '' AS gate_ok, violations FROM gated")
def _run_gate(spark, sf_dir):
    gated = sweep.run_gate(a.runs(spark, sf_dir))
    return gated.select("seq", "gate_ok", F.array_join("violations", "; ").alias("violations"))


@query(
    "t05_best_run",
    f"WITH {GATE_SQL} SELECT seq, name, score, violations = '' AS gate_ok FROM gated ORDER BY violations = '' DESC, score DESC NULLS LAST, seq LIMIT 1",
)
def _best_run(spark, sf_dir):
    return sweep.best_run(sweep.run_gate(a.runs(spark, sf_dir)), "seq").select("seq", "name", "score", "gate_ok")


@query(
    "u06_distinct_candidates",
    f"""WITH {RUNS_SQL.replace('{src}', 'runs')} SELECT array_to_string(lookbacks, ',') AS lookbacks, event_shift, min(seq) AS seq, arg_min(name, seq) AS name
    FROM runs GROUP BY lookbacks, event_shift""",
)
def _distinct_candidates(spark, sf_dir):
    kept = sweep.distinct_candidates(a.runs(spark, sf_dir), "seq")
    return kept.select(F.array_join("lookbacks", ",").alias("lookbacks"), "event_shift", "seq", "name")
