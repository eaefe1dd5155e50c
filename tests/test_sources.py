import datetime as dt
import json

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from panelkiln import session
from panelkiln.operators.rows import attach_daily, keep_first, keep_last, top_rows
from panelkiln.session import fresh_folder, shared_folder
from panelkiln.sources import landing, news, store
from panelkiln.sources.tables import optional_table, read_table, with_month, write_table
from panelkiln.streaming import refresh
from tests.helpers import PRICE_SCHEMA, frame, random_prices

D = dt.date
ROW = "date date, symbol string, close double"


def rows_of(df, *names):
    return sorted(tuple(r[n] for n in names) for r in df.collect())


def test_one_object_per_file_and_odd_payloads(spark, tmp_path):
    price = {"date": "2024-03-01", "open": 1, "high": 2, "low": 0.5, "close": 1.5, "adjClose": 1.4, "volume": 10}
    payloads = {
        "a": {"meta": {"symbol": "AAA", "status_code": 200}, "data": [price, {**price, "date": "2024-03-04"}]},
        "empty": {"meta": {"symbol": "BBB"}, "data": []},
        "none": {"meta": {"symbol": "CCC"}, "data": None},
        "odd": {"meta": {"symbol": "DDD"}, "data": {"error": "no plan"}},
    }
    for name, payload in payloads.items():
        (tmp_path / f"{name}.json").write_text(json.dumps(payload, indent=1))
    prices = landing.landed_prices(landing.read_landing(spark, str(tmp_path), one_per_file=True))
    assert rows_of(prices, "symbol", "date", "adj_close") == [("AAA", D(2024, 3, 1), 1.4), ("AAA", D(2024, 3, 4), 1.4)]


def test_optional_table(spark, tmp_path):
    empty = optional_table(spark, str(tmp_path / "none"), ROW)
    assert empty.columns == ["date", "symbol", "close"] and empty.count() == 0
    spark.range(1).select(F.current_date().alias("date"), F.lit("A").alias("symbol"), F.lit(1.0).alias("close")).write.parquet(
        str(tmp_path / "some")
    )
    assert optional_table(spark, str(tmp_path / "some"), ROW).count() == 1


def test_partitioned_write_prunes(spark, tmp_path):
    df = with_month(frame(spark, random_prices(seed=1, rows=80), PRICE_SCHEMA))
    write_table(df, str(tmp_path / "t"), partition_by="month", sort_by=["symbol", "date"])
    back = read_table(spark, str(tmp_path / "t"))
    assert back.count() == df.count()
    plan = back.filter("month = 202402")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month" in plan


def _two(spark):
    existing = spark.createDataFrame([(D(2024, 1, 1), "A", 1.0), (D(2024, 2, 1), "A", 2.0)], ROW)
    new = spark.createDataFrame([(D(2024, 2, 1), "A", 9.0), (D(2024, 3, 1), "A", 3.0), (D(2024, 3, 1), "A", 3.0)], ROW)
    return existing, new


def test_merge_rules(spark):
    existing, new = _two(spark)
    assert rows_of(store.existing_wins(existing, new), "date", "close") == [
        (D(2024, 1, 1), 1.0), (D(2024, 2, 1), 2.0), (D(2024, 3, 1), 3.0)
    ]
    assert rows_of(store.new_wins(existing, new), "date", "close") == [
        (D(2024, 1, 1), 1.0), (D(2024, 2, 1), 9.0), (D(2024, 3, 1), 3.0)
    ]
    assert store.append_rows(existing, new).count() == 5
    assert store.append_rows(existing, new, max_rows=1, order=[F.col("date")]).count() == 3
    with pytest.raises(ValueError):
        store.append_rows(existing, new, max_rows=1)
    tagged = store.tag_and_stack({"a": existing, "b": new.withColumn("extra", F.lit(1))})
    assert rows_of(tagged.groupBy("statement_type").agg(F.count("extra").alias("n")), "statement_type", "n") == [("a", 0), ("b", 3)]


def test_stored_merges_touch_only_their_months(spark):
    existing, new = _two(spark)
    path = fresh_folder(spark, "test-store")
    store.append_new_prices(spark, path, existing)
    for _ in range(2):
        store.append_new_prices(spark, path, new)
    store.append_new_prices(spark, path, new.limit(0))
    assert rows_of(read_table(spark, path), "date", "close") == [(D(2024, 1, 1), 1.0), (D(2024, 2, 1), 2.0), (D(2024, 3, 1), 3.0)]
    january = {f for f in read_table(spark, path).inputFiles() if "month=202401" in f}
    store.replace_months(spark, path, new)
    table = read_table(spark, path)
    assert rows_of(table, "date", "close") == [(D(2024, 1, 1), 1.0), (D(2024, 2, 1), 9.0), (D(2024, 3, 1), 3.0)]
    assert january == {f for f in table.inputFiles() if "month=202401" in f}


def test_refresh_bound(spark):
    existing = spark.createDataFrame([(D(2024, 3, 1),)], "date date")
    row = store.refresh_bound(existing, D(2024, 1, 1), D(2024, 3, 3)).first()
    assert (row["fetch_from"], row["skip"]) == (D(2024, 3, 4), True)
    row = store.refresh_bound(existing.limit(0), D(2024, 1, 1), D(2024, 3, 3)).first()
    assert (row["fetch_from"], row["skip"]) == (D(2024, 1, 1), False)


def test_fingerprint_ignores_order_and_copies_but_not_settings(spark):
    def digest(names, spec="x"):
        return store.dataset_fingerprint(spark.createDataFrame([(n,) for n in names], "symbol string"), spec).first()[0]

    assert digest(["A", "B", "C"]) == digest(["C", "A", "B", "A"])
    assert len({digest(["A", "B"]), digest(["A", "C"]), digest(["A"]), digest(["A", "B"], "y")}) == 4


def test_repeated_pages_are_dropped(spark):
    rows = [(1, 1, "a"), (1, 2, "b"), (2, 1, "b"), (2, 2, "a"), (3, 1, "a"), (3, 2, "b"), (4, 1, "a")]
    df = spark.createDataFrame(rows, "page int, position int, title string")
    assert {r["page"] for r in news.drop_repeated_pages(df).collect()} == {1, 2, 4}


def test_news_landing(spark):
    schema = "publishedDate string, title string, body string"
    general = spark.createDataFrame([("2024-01-01", "x", "g"), ("2024-02-01", "y", "g"), ("bad", "z", "g")], schema)
    clipped = news.clip_articles(general, D(2024, 1, 15), None)
    assert rows_of(clipped, "title", "symbol") == [("y", "GENERAL")]
    old = general.withColumn("symbol", F.lit("GENERAL")).withColumn("body", F.lit("old"))
    assert rows_of(news.land_articles(old, clipped), "title", "body") == [("x", "old"), ("y", "g"), ("z", "old")]


def test_keep_first_and_last(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, None), (None, 3, "z")], "k string, o int, v string")
    assert rows_of(keep_last(df, ["k"], [F.col("o")]).na.fill("-"), "k", "o", "v") == [("-", 3, "z"), ("a", 2, "-")]
    assert rows_of(keep_first(df, ["k"], [F.col("o")]).na.fill("-"), "k", "o", "v") == [("-", 3, "z"), ("a", 1, "x")]


def test_top_rows_of_a_hot_group(spark):
    df = spark.range(2000).select(F.when(F.col("id") < 1500, "hot").otherwise("cold").alias("g"), F.col("id").alias("v"))
    top = top_rows(df, "g", [F.col("v").desc()], 5, F.col("v"), salts=8)
    got = {g: sorted(r["v"] for r in top.collect() if r["g"] == g) for g in ("hot", "cold")}
    assert got == {"hot": list(range(1495, 1500)), "cold": list(range(1995, 2000))}
    assert top.count() == 10 and "WindowGroupLimit" in top._jdf.queryExecution().executedPlan().toString()


def test_daily_tables_are_broadcast(spark):
    panel = spark.createDataFrame([(D(2024, 1, 1), 1)], "date date, v int")
    daily = panel.groupBy("date").agg(F.count("v").alias("n"))
    assert "BroadcastHashJoin" in attach_daily(panel, daily, "date")._jdf.queryExecution().executedPlan().toString()


def test_shared_folder_is_one_place(spark):
    assert shared_folder(spark) == shared_folder(spark)
    assert fresh_folder(spark, "a") != fresh_folder(spark, "a")


def test_stored_tables_can_be_cleared(spark, monkeypatch):
    monkeypatch.setattr(session, "_MADE", [])
    table = session.stored(spark.range(3))
    path = table.inputFiles()[0].rsplit("/", 1)[0]
    assert session.clear_stored(spark) == 1 and session.clear_stored(spark) == 0
    with pytest.raises(AnalysisException):
        spark.read.parquet(path)


def test_scratch_tables_go_without_the_others(spark, monkeypatch):
    monkeypatch.setattr(session, "_MADE", [])
    kept, scratch = session.stored(spark.range(3)), session.Scratch(spark)
    gone = [scratch.stored(spark.range(n)) for n in (1, 2)]
    paths = [t.inputFiles()[0].rsplit("/", 1)[0] for t in gone]
    scratch.clear()
    scratch.clear()
    for path in paths:
        with pytest.raises(AnalysisException):
            spark.read.parquet(path)
    assert kept.count() == 3 and session.clear_stored(spark) == 1


def test_price_stream_resumes_and_equals_the_batch_merge(spark):
    paths = [fresh_folder(spark, n) for n in ("t-landing", "t-store", "t-checkpoint")]
    rows = random_prices(seed=9, symbols=3, nulls=0)
    prices = frame(spark, rows, PRICE_SCHEMA)
    first, second = prices.filter("symbol < 'S2'"), prices.filter("symbol > 'S0'").withColumn("close", F.col("close") + 1)
    for batch in (first, second):
        landing.as_envelopes(batch).coalesce(1).write.mode("append").json(paths[0])
        refresh.refresh_prices(spark, *paths, files_per_batch=1).awaitTermination()
    want = store.existing_wins(first, second)
    got = read_table(spark, paths[1])
    assert rows_of(got, "symbol", "date", "close") == rows_of(want, "symbol", "date", "close")


def test_article_stream_keeps_late_rows_and_drops_repeats(spark):
    rows = [(D(2024, 1, 1), "a"), (D(2024, 1, 1), "a"), (D(2024, 1, 1), "b"), (D(2024, 1, 2), "a"), (None, "n"), (D(2024, 6, 1), None)]
    for day in ("day", None):
        folder, out, checkpoint = (fresh_folder(spark, n) for n in ("t-articles", "t-out", "t-cp"))
        for batch in (rows[3:], rows[:3], rows[::-1]):  # the newest first, then what is late, then all again
            spark.createDataFrame(batch, "day date, title string").coalesce(1).write.mode("append").parquet(folder)
            stream = refresh.parquet_stream(spark, folder, files_per_batch=1)
            refresh.land_stream(stream, out, checkpoint, ["day", "title"], day=day).awaitTermination()
        got = read_table(spark, out).select(F.col("day").cast("date"), "title")
        assert sorted(map(tuple, got.collect()), key=str) == sorted(set(rows), key=str)


def test_arrival_order_decides_between_new_rows(spark):
    existing = spark.createDataFrame([(D(2024, 1, 1), "A", 1.0)], ROW)
    new = [(D(2024, 2, 1), "A", 9.0, 1), (D(2024, 2, 1), "A", 5.0, 2), (D(2024, 1, 1), "A", 7.0, 3), (D(2024, 1, 1), "A", 8.0, 0)]
    new = spark.createDataFrame(new, ROW + ", seq int")
    assert rows_of(store.existing_wins(existing, new, order=["seq"]), "date", "close") == [(D(2024, 1, 1), 1.0), (D(2024, 2, 1), 9.0)]
    assert rows_of(store.new_wins(existing, new, order=["seq"]), "date", "close") == [(D(2024, 1, 1), 7.0), (D(2024, 2, 1), 5.0)]
    path = fresh_folder(spark, "t-arrivals")
    store.append_new_prices(spark, path, new, order=["seq"])
    assert rows_of(read_table(spark, path), "date", "close") == [(D(2024, 1, 1), 8.0), (D(2024, 2, 1), 9.0)]
    store.replace_months(spark, path, new, order=["seq"])
    assert rows_of(read_table(spark, path), "date", "close") == [(D(2024, 1, 1), 7.0), (D(2024, 2, 1), 5.0)]


def test_landing_loses_no_value(spark, tmp_path):
    def put(name, text):
        (tmp_path / name).write_text(text)

    put("a.json", json.dumps({"meta": {"symbol": "A"}, "data": [{"date": "2024-01-02", "close": "2.5", "volume": 7, "label": "x"}]}))
    envelopes = landing.read_landing(spark, str(tmp_path), one_per_file=True)
    row = landing.landed_prices(envelopes).first()
    assert (row["symbol"], row["close"], row["volume"], row["open"]) == ("A", 2.5, 7.0, None)
    assert landing.vendor_fields(envelopes) == ["close", "date", "label", "volume"]
    assert landing.landed_rows(envelopes).first().asDict() == {"symbol": "A", "close": "2.5", "date": "2024-01-02", "label": "x", "volume": "7"}
    put("b.json", json.dumps({"meta": {"symbol": "B"}, "data": [{"date": "soon", "close": 1}]}))
    with pytest.raises(Exception, match="unreadable price date: soon"):
        landing.landed_prices(landing.read_landing(spark, str(tmp_path), one_per_file=True)).collect()
    put("b.json", '{"meta": {"symbol": "B"}, "data": [')
    envelopes = landing.read_landing(spark, str(tmp_path), one_per_file=True)
    with pytest.raises(Exception, match="unreadable landing file"):
        landing.landed_prices(envelopes).collect()
    assert [r["file"].rsplit("/", 1)[1] for r in landing.broken_files(envelopes).collect()] == ["b.json"]
