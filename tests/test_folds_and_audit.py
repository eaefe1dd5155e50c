import pytest
from pyspark.sql import functions as F

from panelkiln.operators import audit, folds
from tests.helpers import weekdays

SIZES = {"train": 40, "val": 20, "test": 20}


def expected_folds(days, step):
    out, start = [], 0
    while start + 80 <= len(days):
        out.append({"train": days[start:start + 40], "val": days[start + 40:start + 60], "test": days[start + 60:start + 80]})
        start += step
    return out


def as_lists(df):
    got = {}
    for r in df.orderBy("fold", "part", "part_pos").collect():
        got.setdefault(r["fold"], {}).setdefault(r["part"], []).append(r["date"])
    return [got[k] for k in sorted(got)]


@pytest.mark.parametrize(("n", "step"), [(79, 20), (80, 20), (150, 7), (200, 90)])
def test_walk_forward_windows(spark, n, step):
    days = weekdays("2024-01-01", n)
    panel = spark.createDataFrame([(d,) for d in days[::-1] * 2], "decision_date date")
    built = folds.walk_forward(folds.trading_days(panel), **SIZES, step=step)
    assert as_lists(built) == expected_folds(days, step)


def test_purge_embargo_order_and_windows(spark):
    days = weekdays("2024-01-01", 130)
    panel = spark.createDataFrame([(d,) for d in days], "decision_date date")
    built = folds.walk_forward(folds.trading_days(panel), **SIZES, step=20)
    trimmed = folds.purge_and_embargo(built, train=40, val=20, purge=3, embargo=2)
    want = [
        {"train": f["train"][:-3], "val": f["val"][2:-3], "test": f["test"][2:]} for f in expected_folds(days, 20)
    ]
    assert as_lists(trimmed) == want
    assert as_lists(folds.purge_and_embargo(built, train=40, val=20, purge=-1, embargo=-1)) == expected_folds(days, 20)
    assert all(r["ok"] for r in folds.fold_order(trimmed).collect())
    gone = folds.purge_and_embargo(built, train=40, val=20, purge=40, embargo=0)
    assert not any(r["ok"] for r in folds.fold_order(gone).collect())
    last = folds.last_fold(trimmed)
    assert {r["fold"] for r in last.select("fold").distinct().collect()} == {len(want) - 1}
    window = folds.fold_windows(last).filter("part = 'test'").first()
    assert (window["start"], window["end"]) == (want[-1]["test"][0], want[-1]["test"][-1])
    assert folds.in_part(panel, last, "val").count() == 15
    with pytest.raises(ValueError):
        folds.walk_forward(folds.trading_days(panel), train=0, val=1, test=1, step=1)


def _panel(spark, leak):
    days = weekdays("2024-01-01", 90)
    rows = [
        (days[i], days[i - 1] if i else None, days[i + 1], f"S{s}", float((i * 7 + s * 3) % 11), float((i * 5 + s) % 13))
        for i in range(1, 89) for s in range(4)
    ]
    df = spark.createDataFrame(
        rows, "decision_date date, feature_available_date date, label_date date, symbol string, x double, y double"
    )
    return df.withColumn("leak", F.col("y") * 3) if leak else df


def _gate(spark, panel, names):
    built = folds.walk_forward(folds.trading_days(panel), **SIZES, step=20)
    return audit.leakage_gate(
        features=panel, labels=panel, merged=panel, fold=folds.last_fold(built), feature_names=names, target="y"
    ).first()


def test_leakage_gate_passes_clean_panel(spark):
    row = _gate(spark, _panel(spark, False), ["x"])
    assert row["passed"] and row["messages"] == [] and row["suspicious"] == []
    assert all(row["critical"].values()) and len(row["critical"]) == 5


def test_leakage_gate_stops_a_leak(spark):
    row = _gate(spark, _panel(spark, True), ["x", "leak"])
    assert not row["passed"]
    assert row["suspicious"] == ["leak:corr=1.0000"]
    assert row["critical"]["corr_threshold_pass"] is False and row["critical"]["feature_audit"] is True


def test_date_audits(spark):
    panel = _panel(spark, False)
    late = panel.withColumn("feature_available_date", F.col("decision_date"))
    assert audit.feature_audit(late).first()["bad_rows"] == panel.count()
    assert audit.feature_audit(panel.drop("feature_available_date")).first()["message"].startswith("missing")
    assert audit.label_audit(panel.limit(0)).first()["message"] == "labels_empty"
    assert audit.label_audit(panel.withColumn("label_date", F.col("decision_date"))).first()["ok"] is False


def test_correlation_needs_pairs_and_spread(spark):
    rows = [(float(i), 1.0, float(i) if i < 10 else None, float(i)) for i in range(60)]
    df = spark.createDataFrame(rows, "a double, flat double, few double, y double")
    hits = audit.suspicious_features(df, ["a", "flat", "few"], "y").collect()
    assert [r["feature"] for r in hits] == ["a"]


def test_shared_days(spark):
    rows = [(0, "train", "2024-01-01"), (0, "test", "2024-01-01"), (0, "test", "2024-01-02")]
    fold = spark.createDataFrame(rows, "fold int, part string, date string")
    assert audit.shared_days(fold).first()["overlap"] == 1
