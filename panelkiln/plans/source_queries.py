"""Queries over landing, merging and refreshing tables, universe replay and streams."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from panelkiln.functions.text import ticker_from_json
from panelkiln.operators import universe
from panelkiln.operators.rows import keep_first, keep_last, stack
from panelkiln.plans import adapters as a
from panelkiln.plans import sql_parts as s
from panelkiln.plans.registry import counted, query, rounded
from panelkiln.session import fresh_folder, stored
from panelkiln.sources import landing, news, store
from panelkiln.sources.tables import optional_table, read_table, with_month, write_table
from panelkiln.streaming import news as news_stream, refresh

ROUNDED = "symbol, date, " + ", ".join(
    f"round(ln({c}), 6) + 0.0 AS {c}" for c in ("open", "high", "low", "close", "adj_close")
) + ", volume"


def _logs(df):
    """Prices as logs: unit prices sit on rounding ties, their logs do not."""
    names = ("open", "high", "low", "close", "adj_close")
    return rounded(df.select("symbol", "date", *[F.ln(c).alias(c) for c in names], "volume"))


@query(
    "s01_s03_scan",
    """SELECT 'lineitem' AS source, l_returnflag AS flag, count(*) AS n FROM lineitem WHERE l_quantity > 10 GROUP BY l_returnflag""",
)
def _scan(spark, sf_dir):
    """Pruned and filtered scan; S3: a table that is not there counts as empty."""
    lines = read_table(spark, f"{sf_dir}/lineitem.parquet", ["l_returnflag", "l_quantity"])
    nothing = optional_table(spark, f"{sf_dir}/splits.parquet", lines.schema)
    present = stack(
        lines.withColumn("source", F.lit("lineitem")), nothing.withColumn("source", F.lit("splits"))
    ).filter("l_quantity > 10")
    return present.groupBy("source", F.col("l_returnflag").alias("flag")).agg(counted("n"))


@query("s02_t01_write_and_read", f"WITH {s.BARS} SELECT {ROUNDED}, year(date) * 100 + month(date) AS month FROM bars")
def _write_and_read(spark, sf_dir):
    path = fresh_folder(spark, "bars")
    write_table(with_month(a.bars(spark, sf_dir)), path, partition_by="month", sort_by=["symbol", "date"])
    names = ("open", "high", "low", "close", "adj_close")
    month = F.col("month").cast("long").alias("month")
    return rounded(read_table(spark, path).select("symbol", "date", *[F.ln(c).alias(c) for c in names], "volume", month))


@query("s04_landing_json", f"WITH {s.BARS} SELECT {ROUNDED} FROM bars")
def _landing_json(spark, sf_dir):
    """Half of the prices are written as numbers, half as text."""
    path = fresh_folder(spark, "landing")
    bars = a.landed_bars(spark, sf_dir)
    as_text = [F.col(c).cast("string").alias(c) for c in bars.columns if c not in ("symbol", "date")]
    landing.as_envelopes(bars.filter("volume > 25")).write.json(path)
    texts = bars.filter("NOT volume > 25").select("symbol", "date", *as_text)
    landing.as_envelopes(texts).write.mode("append").json(path)
    return _logs(landing.landed_prices(landing.read_landing(spark, path)))


@query(
    "s04_landing_actions",
    """SELECT CAST(l_suppkey AS VARCHAR) AS symbol, CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS date, l_returnflag AS label,
      round(l_quantity, 6) AS dividend, round(l_discount, 6) AS "adjDividend", count(*) AS n FROM lineitem GROUP BY ALL""",
)
def _landing_actions(spark, sf_dir):
    """A payload of another kind keeps the vendor's own columns."""
    path = fresh_folder(spark, "landing")
    rows = a.table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").cast("string").alias("symbol"), F.to_date("l_shipdate").alias("date"),
        F.col("l_returnflag").alias("label"), F.col("l_quantity").alias("dividend"), F.col("l_discount").alias("adjDividend"),
    )
    landing.as_envelopes(rows, "dividends").write.json(path)
    back = landing.landed_rows(landing.read_landing(spark, path))
    back = back.withColumns({c: F.col(c).cast("double") for c in ("dividend", "adjDividend")})
    return rounded(back).groupBy("symbol", "date", "label", "dividend", "adjDividend").agg(counted("n"))


TWO_HALVES = f"""{s.LINES}, {s.bars_from('kept', 'li', "l_returnflag <> 'R'")}, {s.bars_from('fresh', 'li', "l_returnflag = 'R'")}"""


@query(
    "s05_existing_wins",
    f"""WITH {TWO_HALVES}, merged AS (SELECT * FROM kept UNION ALL SELECT * FROM fresh f
      WHERE NOT EXISTS (SELECT 1 FROM kept k WHERE k.symbol = f.symbol AND k.date = f.date)) SELECT {ROUNDED} FROM merged""",
)
def _existing_wins(spark, sf_dir):
    return _logs(store.existing_wins(a.bars_by_flag(spark, sf_dir, False), a.bars_by_flag(spark, sf_dir, True)))


@query(
    "s05_append_to_store",
    f"""WITH {TWO_HALVES}, merged AS (SELECT * FROM kept UNION ALL SELECT * FROM fresh f
      WHERE NOT EXISTS (SELECT 1 FROM kept k WHERE k.symbol = f.symbol AND k.date = f.date)) SELECT {ROUNDED} FROM merged""",
)
def _append_to_store(spark, sf_dir):
    """S5 on a stored table; the second batch arrives twice and must count once."""
    path = fresh_folder(spark, "store")
    fresh = a.bars_by_flag(spark, sf_dir, True)
    for batch in (a.bars_by_flag(spark, sf_dir, False), fresh, fresh):
        store.append_new_prices(spark, path, batch)
    return _logs(read_table(spark, path))


@query(
    "s06_new_wins",
    f"""WITH {TWO_HALVES}, merged AS (SELECT * FROM fresh UNION ALL SELECT * FROM kept k
      WHERE NOT EXISTS (SELECT 1 FROM fresh f WHERE k.symbol = f.symbol AND k.date = f.date)) SELECT {ROUNDED} FROM merged""",
)
def _new_wins(spark, sf_dir):
    return _logs(store.new_wins(a.bars_by_flag(spark, sf_dir, False), a.bars_by_flag(spark, sf_dir, True)))


ARRIVALS = f"""WITH {s.LINES}, {s.bars_from('kept', 'li', "l_returnflag <> 'R'")},
ranked AS (SELECT symbol, date, u, q, d, row_number() OVER (PARTITION BY symbol, date ORDER BY l_orderkey, l_linenumber) AS first_rn,
  row_number() OVER (PARTITION BY symbol, date ORDER BY l_orderkey DESC, l_linenumber DESC) AS last_rn FROM li WHERE l_returnflag = 'R')"""
ARRIVED = "symbol, date, u AS open, u AS high, u AS low, u AS close, u * (1 - d) AS adj_close, q AS volume FROM ranked"


@query(
    "s05_first_arrival_wins",
    f"""{ARRIVALS}, fresh AS (SELECT {ARRIVED} WHERE first_rn = 1), merged AS (SELECT * FROM kept UNION ALL SELECT * FROM fresh f
      WHERE NOT EXISTS (SELECT 1 FROM kept k WHERE k.symbol = f.symbol AND k.date = f.date)) SELECT {ROUNDED} FROM merged""",
)
def _first_arrival_wins(spark, sf_dir):
    """S5 on a batch whose keys repeat: the first to arrive stays, whatever its values."""
    new = a.returned_lines(spark, sf_dir)
    return _logs(store.existing_wins(a.bars_by_flag(spark, sf_dir, False), new, order=["arrival"]))


@query(
    "s06_last_arrival_wins",
    f"""{ARRIVALS}, fresh AS (SELECT {ARRIVED} WHERE last_rn = 1), merged AS (SELECT * FROM fresh UNION ALL SELECT * FROM kept k
      WHERE NOT EXISTS (SELECT 1 FROM fresh f WHERE k.symbol = f.symbol AND k.date = f.date)) SELECT {ROUNDED} FROM merged""",
)
def _last_arrival_wins(spark, sf_dir):
    new = a.returned_lines(spark, sf_dir)
    return _logs(store.new_wins(a.bars_by_flag(spark, sf_dir, False), new, order=["arrival"]))


@query(
    "s06_replace_in_store",
    f"""WITH {TWO_HALVES}, merged AS (SELECT * FROM fresh UNION ALL SELECT * FROM kept k
      WHERE NOT EXISTS (SELECT 1 FROM fresh f WHERE k.symbol = f.symbol AND k.date = f.date)) SELECT {ROUNDED} FROM merged""",
)
def _replace_in_store(spark, sf_dir):
    path = fresh_folder(spark, "store")
    for returned in (False, True):
        store.replace_months(spark, path, a.bars_by_flag(spark, sf_dir, returned))
    return _logs(read_table(spark, path))


@query(
    "s07_t03_append_rows",
    """WITH new AS (SELECT l_suppkey AS symbol, CAST(l_shipdate AS DATE) AS date, l_extendedprice AS eps FROM lineitem WHERE l_linenumber = 1),
    head AS (SELECT symbol, date, eps, NULL AS revenue FROM new ORDER BY symbol, date, eps LIMIT 500)
    SELECT symbol, date, eps, revenue FROM head UNION ALL SELECT l_suppkey, CAST(l_shipdate AS DATE), NULL, l_extendedprice FROM lineitem WHERE l_linenumber = 2""",
)
def _append_rows(spark, sf_dir):
    """Tables of different shape appended; the operator's own row limit is exercised."""
    lines = a.table(spark, sf_dir, "lineitem")
    key = [F.col("l_suppkey").alias("symbol"), F.to_date("l_shipdate").alias("date")]
    existing = lines.filter("l_linenumber = 2").select(*key, F.col("l_extendedprice").alias("revenue"))
    new = lines.filter("l_linenumber = 1").select(*key, F.col("l_extendedprice").alias("eps"))
    return store.append_rows(existing, new, max_rows=500, order=[F.col("symbol"), F.col("date"), F.col("eps")])


@query(
    "s08_statement_union",
    """SELECT statement_type, symbol, count(*) AS n, round(sum(revenue), 2) + 0.0 AS revenue, round(sum(assets), 2) + 0.0 AS assets FROM (
      SELECT 'income' AS statement_type, l_suppkey AS symbol, l_extendedprice AS revenue, NULL::DOUBLE AS assets FROM lineitem WHERE l_returnflag = 'A'
      UNION ALL SELECT 'balance', l_suppkey, NULL, l_quantity FROM lineitem WHERE l_returnflag = 'N'
      UNION ALL SELECT 'cashflow', l_suppkey, l_tax, l_quantity FROM lineitem WHERE l_returnflag = 'R') GROUP BY ALL""",
)
def _statement_union(spark, sf_dir):
    lines = a.table(spark, sf_dir, "lineitem").withColumnRenamed("l_suppkey", "symbol")

    def of(flag, *columns):
        return lines.filter(F.col("l_returnflag") == flag).select("symbol", *columns)

    revenue, assets = F.col("l_extendedprice").alias("revenue"), F.col("l_quantity").alias("assets")
    tagged = store.tag_and_stack(
        {"income": of("A", revenue), "balance": of("N", assets), "cashflow": of("R", F.col("l_tax").alias("revenue"), assets)}
    )
    totals = tagged.groupBy("statement_type", "symbol").agg(
        counted("n"), F.sum("revenue").alias("revenue"), F.sum("assets").alias("assets")
    )
    return rounded(totals, 2)


@query(
    "s09_refresh_bound",
    f"""WITH m AS (SELECT max(CAST(l_shipdate AS DATE)) AS last_date FROM lineitem)
    SELECT last_date, {s.bday('last_date', 1)} AS fetch_from, {s.bday('last_date', 1)} > DATE '2001-11-30' AS skip FROM m""",
)
def _refresh_bound(spark, sf_dir):
    lines = a.table(spark, sf_dir, "lineitem").select(F.col("l_shipdate").alias("date"))
    return store.refresh_bound(lines, date(1995, 1, 1), date(2001, 11, 30))


LANDED_NEWS = """stock AS (SELECT 'U' || user_id AS symbol, CAST(ts AS DATE) AS day, event_type AS title, 'stock' AS feed, event_id FROM events WHERE event_type <> 'error'),
general AS (SELECT 'GENERAL' AS symbol, CAST(ts AS DATE) AS day, event_type AS title, 'general' AS feed, event_id FROM events
  WHERE event_type IN ('error', 'view') AND CAST(ts AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-20'),
old AS (SELECT 'U' || user_id AS symbol, CAST(ts AS DATE) AS day, event_type AS title, 'old' AS feed, event_id FROM events WHERE event_type = 'click')"""


def _feed(spark, sf_dir, condition, feed, with_symbol=True):
    events = a.table(spark, sf_dir, "events").filter(condition)
    symbol = [F.concat(F.lit("U"), F.col("user_id").cast("string")).alias("symbol")] if with_symbol else []
    return events.select(
        *symbol, F.to_date("ts").cast("string").alias("publishedDate"), F.col("event_type").alias("title"),
        F.lit(feed).alias("feed"), "event_id",
    )


@query(
    "s10_news_landing",
    f"""WITH {LANDED_NEWS}, every AS (SELECT *, 0 AS b FROM old UNION ALL SELECT *, 1 FROM stock UNION ALL SELECT *, 2 FROM general)
    SELECT symbol, CAST(day AS VARCHAR) AS "publishedDate", title, feed, event_id FROM (SELECT *, row_number() OVER (PARTITION BY symbol, day, title ORDER BY b DESC, -event_id DESC) AS rn FROM every) WHERE rn = 1""",
)
def _news_landing(spark, sf_dir):
    existing = _feed(spark, sf_dir, "event_type = 'click'", "old")
    stock = _feed(spark, sf_dir, "event_type <> 'error'", "stock")
    market = _feed(spark, sf_dir, "event_type IN ('error', 'view')", "general", with_symbol=False)
    clipped = news.clip_articles(market, date(2024, 1, 5), date(2024, 1, 20))
    # Articles arrive by falling id, so that the order of arrival is not that of the values.
    batches = [df.withColumn("arrival", -F.col("event_id")) for df in (existing, stock, clipped)]
    return news.land_articles(*batches, order=["arrival"])


@query(
    "s11_repeated_pages",
    """WITH rows AS (SELECT l_orderkey AS page, CAST(l_linenumber AS BIGINT) AS position, l_returnflag AS title FROM lineitem),
    marks AS (SELECT page, string_agg(position || '|' || title, '~' ORDER BY position, title) AS marker FROM rows GROUP BY page),
    firsts AS (SELECT min(page) AS page FROM marks GROUP BY marker)
    SELECT page, position, title FROM rows WHERE page IN (SELECT page FROM firsts)""",
)
def _repeated_pages(spark, sf_dir):
    """Each order's lines as a feed page; pages with the same content as an earlier one drop out."""
    pages = a.table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("page"),
        F.col("l_linenumber").cast("long").alias("position"),
        F.col("l_returnflag").alias("title"),
    )
    return news.drop_repeated_pages(pages)


@query(
    "s12_f13_dataset_fingerprint",
    """WITH d AS (SELECT DISTINCT sha1(CAST(l_suppkey AS VARCHAR)) AS h FROM lineitem),
    t AS (SELECT count(*) AS n, sum(('0x' || substr(h, 1, 15))::BIGINT) AS a, sum(('0x' || substr(h, 16, 15))::BIGINT) AS b FROM d)
    SELECT substr(sha1('1995-01-01|' || sha1(n || ':' || a || ':' || b)), 1, 12) AS dataset_id FROM t""",
)
def _dataset_fingerprint(spark, sf_dir):
    return store.dataset_fingerprint(a.table(spark, sf_dir, "lineitem"), "1995-01-01", symbol="l_suppkey")


@query(
    "u02_keep_first_and_last",
    """SELECT l_suppkey, l_shipdate, arg_min(struct_pack(k := l_orderkey, n := l_linenumber, q := l_quantity, e := l_extendedprice), row(l_orderkey, l_linenumber, l_quantity, l_extendedprice)).e AS first_price,
    arg_max(struct_pack(k := l_orderkey, n := l_linenumber, q := l_quantity, e := l_extendedprice), row(l_orderkey, l_linenumber, l_quantity, l_extendedprice)).e AS last_price FROM lineitem GROUP BY 1, 2""",
)
def _keep_first_and_last(spark, sf_dir):
    keys = ["l_suppkey", "l_shipdate"]
    order = [F.col(c) for c in ("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice")]
    lines = a.table(spark, sf_dir, "lineitem").select(*keys, *order)
    first = keep_first(lines, keys, order).select(*keys, F.col("l_extendedprice").alias("first_price"))
    last = keep_last(lines, keys, order).select(*keys, F.col("l_extendedprice").alias("last_price"))
    return first.join(last, keys)


@query("u03_distinct_symbols", "SELECT DISTINCT CAST(l_suppkey AS VARCHAR) AS symbol FROM lineitem")
def _distinct_symbols(spark, sf_dir):
    return a.table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").cast("string").alias("symbol")).distinct()


# --- universe -----------------------------------------------------------------------------------

START, END = date(1996, 3, 2), date(2000, 6, 30)

# Sequential in spirit: the state on each business day is looked up from the last change up to it.
UNIVERSE_SQL = f"""raw AS (SELECT CAST(o_orderdate AS DATE) AS d, o_orderkey AS seq, CASE WHEN o_orderstatus IN ('O', 'P') THEN 'C' || o_custkey END AS added,
    CASE WHEN o_orderstatus = 'F' THEN 'C' || o_custkey WHEN o_orderstatus = 'P' THEN 'C' || (o_custkey // 2) END AS removed FROM orders),
ch AS (SELECT added AS symbol, false AS removed, d, seq FROM raw WHERE added IS NOT NULL UNION ALL SELECT removed, true, d, seq FROM raw WHERE removed IS NOT NULL),
later AS (SELECT *, CASE WHEN isodow(d) < 6 THEN d ELSE {s.bday('d', 1)} END AS eff FROM ch WHERE d >= DATE '1996-03-02'),
init AS (SELECT symbol, removed AS member FROM (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY d, seq, removed DESC) AS rn FROM later) WHERE rn = 1
  UNION ALL SELECT 'C' || c_custkey, true FROM customer WHERE c_acctbal > 0 AND 'C' || c_custkey NOT IN (SELECT symbol FROM later)),
per_day AS (SELECT symbol, eff, NOT removed AS member FROM (SELECT *, row_number() OVER (PARTITION BY symbol, eff ORDER BY d DESC, seq DESC, removed DESC) AS rn FROM later WHERE eff <= DATE '2000-06-30') WHERE rn = 1),
cal AS (SELECT CAST(unnest(generate_series(DATE '1996-03-02', DATE '2000-06-30', INTERVAL 1 DAY)) AS DATE) AS date),
grid AS (SELECT i.symbol, c.date, i.member AS m0, p.member AS m1 FROM init i JOIN cal c ON isodow(c.date) < 6
  LEFT JOIN per_day p ON p.symbol = i.symbol AND p.eff = c.date),
state AS (SELECT symbol, date, coalesce(last_value(m1 IGNORE NULLS) OVER (PARTITION BY symbol ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), m0) AS member FROM grid),
days AS (SELECT date, symbol FROM state WHERE member)"""


def _intervals(spark, sf_dir):
    events = universe.membership_events(a.index_changes(spark, sf_dir), "seq")
    return universe.membership_intervals(a.index_members(spark, sf_dir), events, START, END)


@query(
    "a14_j07_point_in_time_days",
    f"WITH {UNIVERSE_SQL} SELECT symbol, count(*) AS days, min(date) AS first_day, max(date) AS last_day, sum(date - DATE '1970-01-01')::BIGINT AS day_sum FROM days GROUP BY symbol",
)
def _point_in_time_days(spark, sf_dir):
    """Membership replayed and spelled out in business days, with a checksum of the days per symbol."""
    days = universe.membership_days(_intervals(spark, sf_dir))
    return days.groupBy("symbol").agg(
        counted("days"), F.min("date").alias("first_day"), F.max("date").alias("last_day"),
        F.sum(F.unix_date("date").cast("long")).alias("day_sum"),
    )


@query(
    "a14_u07_point_in_time_by_day",
    f"WITH {UNIVERSE_SQL} SELECT date, count(*) AS members, min(symbol) AS first_symbol, max(symbol) AS last_symbol FROM days GROUP BY date",
)
def _point_in_time_by_day(spark, sf_dir):
    return universe.members_by_day(_intervals(spark, sf_dir))


@query(
    "j02_orders_of_members",
    f"""WITH {UNIVERSE_SQL} SELECT o_orderkey, 'C' || o_custkey AS symbol, CAST(o_orderdate AS DATE) AS decision_date FROM orders
    JOIN days ON symbol = 'C' || o_custkey AND date = CAST(o_orderdate AS DATE) WHERE isodow(o_orderdate) < 6""",
)
def _orders_of_members(spark, sf_dir):
    """Rows kept by membership spans, which are never spelled out."""
    rows = a.table(spark, sf_dir, "orders").select(
        "o_orderkey", F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("symbol"),
        F.to_date("o_orderdate").alias("decision_date"),
    )
    return universe.members_within(rows.filter(F.weekday("decision_date") < 5), _intervals(spark, sf_dir))


@query(
    "j13_static_universe",
    """WITH cal AS (SELECT CAST(unnest(generate_series(DATE '1999-01-01', DATE '1999-12-31', INTERVAL 1 DAY)) AS DATE) AS date)
    SELECT date, 'S' || s_suppkey AS symbol, true AS is_member FROM supplier, cal WHERE isodow(date) < 6""",
)
def _static_universe(spark, sf_dir):
    symbols = a.table(spark, sf_dir, "supplier").select(F.concat(F.lit(" s"), F.col("s_suppkey").cast("string")).alias("symbol"))
    return universe.static_membership(symbols, date(1999, 1, 1), date(1999, 12, 31))


@query(
    "f10_f11_symbols_from_json",
    """SELECT c_custkey, CASE WHEN c_nationkey < 8 THEN 'C' || c_custkey WHEN c_nationkey < 16 THEN 'T.' || c_custkey END AS symbol FROM customer""",
)
def _symbols_from_json(spark, sf_dir):
    """Plain tickers, objects with a ticker field, and company names, which are no tickers."""
    key, nation = F.col("c_custkey").cast("string"), F.col("c_nationkey")
    raw = (
        F.when(nation < 8, F.concat(F.lit(" c"), key, F.lit(" ")))
        .when(nation < 16, F.concat(F.lit('{"symbol": "Some Name, Inc.", "ticker": "t.'), key, F.lit('"}')))
        .otherwise(F.concat(F.lit("Customer "), key, F.lit(", Inc.")))
    )
    return a.table(spark, sf_dir, "customer").select("c_custkey", ticker_from_json(raw).alias("symbol"))


# --- streams ------------------------------------------------------------------------------------


@query("x01_price_stream", f"WITH {s.BARS} SELECT {ROUNDED} FROM bars")
def _price_stream(spark, sf_dir):
    """Landed envelopes streamed into the price table; running it again changes nothing."""
    folders = [fresh_folder(spark, name) for name in ("landing", "prices", "stream")]
    landing.as_envelopes(a.landed_bars(spark, sf_dir)).write.json(folders[0], compression="gzip")
    for _ in range(2):
        refresh.refresh_prices(spark, *folders).awaitTermination()
    return _logs(read_table(spark, folders[1]))


@query(
    "x02_article_stream",
    "SELECT user_id, CAST(ts AS DATE) AS day, event_type, 1::BIGINT AS n FROM events GROUP BY 1, 2, 3",
)
def _article_stream(spark, sf_dir):
    """One article per user, day and kind out of a stream with repeats, the newest files first, one a batch."""
    landing_path, path, checkpoint = (fresh_folder(spark, name) for name in ("feed", "articles", "stream"))
    a.table(spark, sf_dir, "events").repartitionByRange(4, F.desc("ts")).write.parquet(landing_path)
    stream = refresh.parquet_stream(spark, landing_path, files_per_batch=1).select(
        "user_id", F.to_date("ts").alias("day"), "event_type"
    )
    keys = ["user_id", "day", "event_type"]
    refresh.land_stream(stream, path, checkpoint, keys, day="day").awaitTermination()
    return read_table(spark, path).groupBy("user_id", "day", "event_type").agg(counted("n"))


def late_and_counted(spark, late, days):
    """Articles by day and source: those on the side table, each once, and those counted."""
    aside = read_table(spark, late).select("article", F.to_date("published").alias("day"), "source").distinct()
    aside = aside.groupBy("day", "source").agg(counted("n")).select(F.lit("late").alias("kind"), "day", "source", "n")
    return aside.unionByName(days.groupBy("day", "source").agg(F.sum("articles").alias("n")).withColumn("kind", F.lit("counted")))


FEED_BATCHES = 6


@query(
    "x02_news_counts_in_state",
    f"""WITH span AS (SELECT min(ts) AS a, max(ts) AS z FROM events),
    e AS (SELECT ts, CAST(ts AS DATE) AS day, coalesce(json_extract_string(props, '$.k'), 'unknown') AS source,
      least({FEED_BATCHES - 1}, {FEED_BATCHES} * date_diff('day', CAST(a AS DATE), CAST(ts AS DATE)) // (date_diff('day', CAST(a AS DATE), CAST(z AS DATE)) + 1)
        + CASE WHEN event_id % 10 = 0 THEN 1 ELSE 0 END) AS b FROM events, span),
    m AS (SELECT b, max(ts) AS latest FROM e GROUP BY b),
    w AS (SELECT b, max(latest) OVER (ORDER BY b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - INTERVAL 1 DAY AS bound FROM m),
    judged AS (SELECT e.*, coalesce(ts <= bound, false) AS late FROM e JOIN w USING (b)),
    ended AS (SELECT CAST(max(ts) - INTERVAL 1 DAY AS DATE) AS open_day FROM e)
    SELECT 'late' AS kind, day, source, count(*) AS n FROM judged WHERE late GROUP BY ALL
    UNION ALL SELECT 'counted', day, source, count(*) FROM judged, ended WHERE NOT late AND day < open_day GROUP BY ALL""",
)
def _news_counts_in_state(spark, sf_dir):
    """Articles of each day and source counted in state, and those that came over a day late; a tenth comes one batch later, purchases twice."""
    feed, folder = fresh_folder(spark, "feed"), fresh_folder(spark, "news")
    events = a.table(spark, sf_dir, "events")
    span = events.agg(F.to_date(F.min("ts")).alias("a"), F.to_date(F.max("ts")).alias("z")).first()
    days = (span["z"] - span["a"]).days + 1 if span["a"] else 1
    number = F.floor(FEED_BATCHES * F.datediff("ts", F.lit(span["a"])) / days) + F.when(F.col("event_id") % 10 == 0, 1).otherwise(0)
    news = events.select("event_id", "event_type", F.col("ts").cast("string").alias("publishedDate"), F.get_json_object("props", "$.k").alias("site"), F.least(F.lit(FEED_BATCHES - 1), number).alias("b"))
    news = stored(news.union(news.where("event_type = 'purchase'")), "articles")
    for b in range(FEED_BATCHES):
        news.where(F.col("b") == b).coalesce(1).write.mode("append").parquet(feed)
    news_stream.refresh_news(spark, refresh.parquet_stream(spark, feed, files_per_batch=1), folder, ["event_id"], delay="1 day")
    return late_and_counted(spark, f"{folder}/late", read_table(spark, f"{folder}/counts").withColumnRenamed("event_date", "day"))
