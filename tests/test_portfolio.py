import datetime as dt
import itertools

import numpy as np
import pytest

from panelkiln.operators import portfolio_grid
from panelkiln.operators.portfolio import PortfolioRules, portfolio_summary, run_portfolio
from tests.helpers import weekdays

SCHEMA = "decision_date date, symbol string, y_pred double, y_true double, adv20_dollar double, vol_20d double"


def simulate(rows, rules):
    """Walk the days one by one, carrying the weights."""
    days, held, week = {}, {}, None
    for r in rows:
        if r[2] is not None and r[3] is not None:
            days.setdefault(r[0], []).append(r)
    out, equity, peak = [], 1.0, None
    for day in sorted(days):
        today = {r[1]: r for r in days[day]}
        token = day.isocalendar()[:2]
        before = dict(held)
        turnover = 0.0
        if rules.rebalance == "daily" or token != week or not held:
            ranked = sorted(today.values(), key=lambda r: (-r[2], r[1]))
            n_long = min(rules.topn, rules.max_names, len(ranked))
            weights = {r[1]: 1.0 / n_long for r in ranked[:n_long]}
            if rules.long_short:
                n_short = min(rules.topn, rules.max_names - n_long, len(ranked) - n_long)
                weights.update({r[1]: -1.0 / n_short for r in ranked[len(ranked) - n_short:]} if n_short else {})
                capped = {k: max(-rules.single_name_cap, min(rules.single_name_cap, v)) for k, v in weights.items()}
                gross = sum(abs(v) for v in capped.values())
                weights = {k: v / gross for k, v in capped.items()}
            turnover = sum(abs(weights.get(k, 0) - held.get(k, 0)) for k in {*weights, *held}) / 2
            held, week = weights, token
        present = {k: w for k, w in held.items() if k in today}
        if not present:
            continue
        impacts, vols = [], []
        for k, w in held.items():
            adv, vol = (today[k][4], today[k][5]) if k in today else (None, None)
            impacts.append(abs(w - before.get(k, 0)) * rules.notional / (adv or 1e12))
            vols.append(vol or 0.0)
        bps = rules.slippage_base_bps + rules.slippage_k_adv * np.mean(impacts) + rules.slippage_k_vol * np.mean(vols)
        cost = (rules.commission_bps + bps) / 1e4 * turnover
        gross_return = sum(w * today[k][3] for k, w in present.items())
        equity *= 1 + gross_return - cost
        peak = equity if peak is None else max(peak, equity)
        out.append((day, gross_return, turnover, cost, len(present), bps, equity, equity / peak - 1))
    return out


def random_predictions(seed):
    rng = np.random.default_rng(seed)
    out = []
    for day in weekdays("2024-01-01", 40):
        if rng.random() < 0.15:
            continue
        for s in range(9):
            if rng.random() < 0.25:
                continue
            out.append(
                (
                    day, f"S{s}", float(rng.integers(0, 4)), None if rng.random() < 0.05 else float(rng.normal(0, 0.02)),
                    [None, 0.0, 1e6, 5e6][rng.integers(0, 4)], None if rng.random() < 0.2 else 0.02,
                )
            )
    return out


@pytest.mark.parametrize(
    "rules",
    [
        PortfolioRules(topn=3, max_names=3),
        PortfolioRules(topn=20, max_names=20, rebalance="weekly"),
        PortfolioRules(topn=2, max_names=5, long_short=True, single_name_cap=0.3),
        PortfolioRules(topn=4, max_names=6, long_short=True, single_name_cap=0.2, rebalance="weekly"),
        PortfolioRules(topn=5, max_names=3, long_short=True, rebalance="weekly"),
    ],
)
def test_portfolio_equals_a_day_by_day_walk(spark, rules):
    rows = random_predictions(seed=rules.topn)
    daily, positions = run_portfolio(spark.createDataFrame(rows[::-1], SCHEMA).repartition(3), rules)
    want = simulate(rows, rules)
    got = daily.orderBy("date").collect()
    assert [r["date"] for r in got] == [w[0] for w in want]
    names = ("gross_return", "turnover", "cost_total", "n_names", "slip_bps_est", "equity", "drawdown")
    for i, name in enumerate(names, start=1):
        np.testing.assert_allclose([float(r[name]) for r in got], [w[i] for w in want], atol=1e-10, err_msg=name)
    assert positions.count() == sum(w[4] for w in want)


def test_a_grid_of_rules_equals_run_after_run(spark):
    """50 rules in one plan: each equals the day-by-day walk, and some of them run_portfolio itself."""
    rows = random_predictions(seed=8)
    df = spark.createDataFrame(rows[::-1], SCHEMA).repartition(3)
    rules = {}
    for topn, names, long_short, mode in itertools.product((1, 2, 3, 5, 20), (3, 4, 6, 20), (False, True), ("daily", "weekly")):
        rules[f"{topn}/{names}/{long_short}/{mode}"] = PortfolioRules(
            topn=topn, max_names=names, long_short=long_short, rebalance=mode, single_name_cap=0.1 * (1 + topn % 3), commission_bps=topn / 2, notional=1e5 * names
        )
    rules = dict(list(rules.items())[:50])
    grid = portfolio_grid.run_portfolio_grid(df, rules).cache()
    got = {}
    for r in grid.orderBy("date").collect():
        got.setdefault(r.rule, []).append(r)
    names = ("gross_return", "turnover", "cost_total", "n_names", "slip_bps_est", "equity", "drawdown")
    assert len(rules) == 50 and set(got) == set(rules)
    for name, own in rules.items():
        want = simulate(rows, own)
        assert [r.date for r in got[name]] == [w[0] for w in want]
        for i, c in enumerate(names, start=1):
            np.testing.assert_allclose([float(r[c]) for r in got[name]], [w[i] for w in want], atol=1e-10, err_msg=f"{name} {c}")
    summary = {r.rule: r for r in portfolio_grid.grid_summary(grid).collect()}
    for name in list(rules)[::20]:
        daily, _ = run_portfolio(df, rules[name])
        one = portfolio_summary(daily).first()
        assert one["days"] == summary[name]["days"] and one["sharpe"] == pytest.approx(summary[name]["sharpe"])
    with pytest.raises(ValueError):
        portfolio_grid.run_portfolio_grid(df, {})


def test_weekly_turnover_is_no_higher_and_summary_is_finite(spark):
    rows = []
    for i, day in enumerate(weekdays("2024-01-01", 10)):
        for s, score, ret in (("AAA", 0.9, 0.003), ("BBB", 0.6, 0.002), ("CCC", 0.2, 0.001)):
            rows.append((day, s, score - i * 0.01, ret, 1e6, 0.02))
    df = spark.createDataFrame(rows, SCHEMA)
    mean = {}
    for mode in ("daily", "weekly"):
        daily, _ = run_portfolio(df, PortfolioRules(topn=2, max_names=2, rebalance=mode, slippage_k_adv=5, slippage_k_vol=3))
        row = portfolio_summary(daily).first()
        assert row["days"] == 10 and all(np.isfinite(float(v)) for v in row)
        mean[mode] = row["avg_turnover"]
    assert mean["weekly"] <= mean["daily"] + 1e-12


def test_no_usable_rows(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 1), "A", None, 0.1, None, None)], SCHEMA)
    daily, positions = run_portfolio(df)
    row = portfolio_summary(daily).first()
    assert row["days"] == 0 and row["sharpe"] is None and positions.count() == 0


def test_bad_rules():
    with pytest.raises(ValueError):
        PortfolioRules(rebalance="hourly")
    with pytest.raises(ValueError):
        PortfolioRules(topn=0)
