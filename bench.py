"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Every query runs in full: its result is written to Spark's no-op sink. A query
is run once to warm up and then $BENCH_RUNS times; its figure is the median.
``land_prices`` is the step that builds the stored price table the other panel
queries read, and is timed by itself.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from panelkiln.plans import adapters, catalog  # noqa: E402
from panelkiln.session import clear_stored, fresh_folder, local_session  # noqa: E402
from panelkiln.sources.tables import write_table  # noqa: E402

HEADLINE = (
    "price_features",
    "labelled_returns",
    "news_features",
    "f04_text_sentiment",
    "a13_quality_gate",
    "a14_j07_point_in_time_days",
    "j02_members_only",
    "j03_features_with_earnings",
    "a22_feature_target_correlation",
    "a16_daily_rank_ic",
    "b01_b09_daily_long_only",
    "b01_b09_weekly_long_short",
    "s05_existing_wins",
    "s10_news_landing",
    "a29_run_summary",
    "m02_m03_linear_scores",
)


def seconds(action) -> float:
    start = time.perf_counter()
    action()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    spark = local_session(cpus, app="panelkiln-bench")
    spark.sparkContext.setLogLevel("ERROR")

    def land() -> None:
        bars = adapters.bars(spark, sf_dir)
        write_table(bars, fresh_folder(spark, "bench"), sort_by=["symbol", "date"])

    def run(name: str) -> None:
        catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()

    timed = {"land_prices": land, **{name: lambda name=name: run(name) for name in HEADLINE}}
    adapters.landed_bars(spark, sf_dir)
    results = {}
    for name, action in timed.items():
        action()
        results[name] = round(statistics.median(seconds(action) for _ in range(runs)), 3)
        print(f"{name}: {results[name]}", file=sys.stderr, flush=True)
    line = {
        "metric": "headline_queries_total",
        "value": round(sum(results.values()), 3),
        "unit": "sec",
        "queries": results,
        "sf": os.path.basename(sf_dir),
        "cpus": cpus,
    }
    print(json.dumps(line), flush=True)
    clear_stored(spark)
    spark.stop()


if __name__ == "__main__":
    main()
