"""Queries over price, earnings and news features and labels."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelkiln.functions import dates, frames, text
from panelkiln.functions.numeric import fill_zero, growth, number
from panelkiln.operators import earnings as earnings_ops
from panelkiln.operators import asof, feature_store, incremental, labels, news, price_features
from panelkiln.operators.rows import attach_daily
from panelkiln.operators.universe import static_spans
from panelkiln.plans import adapters as a
from panelkiln.plans import sql_parts as s
from panelkiln.plans.registry import counted, query, rounded
from panelkiln.session import fresh_folder
from panelkiln.sources import panels, store

LOOKBACKS = (1, 5, 20, 60, 120)
FEATURE_COLUMNS = [f"ret_{k}d" for k in LOOKBACKS] + [
    "corr_mkt_20d", "vol_20d", "range_20d", "adv20_dollar", "volume_z_20d", "mom_20_60",
]


def r6(*names: str, digits: int = 6) -> str:
    return ", ".join(f"round({n}, {digits}) + 0.0 AS {n}" for n in names)


def price_panel(spark, sf_dir):
    return price_features.build_price_features(a.landed_bars(spark, sf_dir), lookbacks=LOOKBACKS)


@query(
    "price_features",
    f"WITH {s.BARS}, {s.features(list(LOOKBACKS))} SELECT decision_date, symbol, "
    f"{r6(*[c for c in FEATURE_COLUMNS if c != 'adv20_dollar'])}, round(ln(adv20_dollar), 6) + 0.0 AS ln_adv20_dollar, "
    "feature_available_date FROM feats",
)
def _price_features(spark, sf_dir):
    """W1-W11, P12. The traded value is shown as its log: sums of cents sit on rounding ties."""
    panel = price_panel(spark, sf_dir).withColumn("ln_adv20_dollar", F.ln("adv20_dollar")).drop("adv20_dollar")
    return rounded(panel)


@query(
    "labelled_returns",
    f"WITH {s.BARS}, {s.features([1, 5, 20])}, {s.labels(5)} SELECT decision_date, symbol, "
    f"{r6('ret_1d', 'ret_5d', 'ret_20d')}, feature_available_date, label_date, {r6('future_return_5d')}, horizon "
    "FROM feats JOIN labels_h USING (decision_date, symbol)",
)
def labelled_returns(spark, sf_dir):
    """Lagged returns with the next 5-row return."""
    bars = a.landed_bars(spark, sf_dir)
    features = price_features.build_price_features(bars, lookbacks=(1, 5, 20), label_horizon=5)
    return rounded(
        features.select(
            "decision_date", "symbol", "ret_1d", "ret_5d", "ret_20d", "feature_available_date", "label_date",
            "future_return_5d", "horizon",
        )
    )


@query(
    "w02_padded_returns",
    f"""WITH {s.BARS}, gaps AS (SELECT symbol, date, CASE WHEN volume > 10 THEN close END AS px FROM bars),
    padded AS (SELECT *, last_value(px IGNORE NULLS) OVER (PARTITION BY symbol ORDER BY date
      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS p FROM gaps)
    SELECT symbol, date, px IS NULL AS gap, round(p / lag(p) OVER w - 1, 6) + 0.0 AS ret_1d,
           round(p / lag(p, 5) OVER w - 1, 6) + 0.0 AS ret_5d
    FROM padded WINDOW w AS (PARTITION BY symbol ORDER BY date)""",
)
def _padded_returns(spark, sf_dir):
    w = frames.history("date")
    rows = a.landed_bars(spark, sf_dir).select("symbol", "date", F.when(F.col("volume") > 10, F.col("close")).alias("px"))
    p = F.col("_p")
    return rounded(
        rows.withColumn("_p", frames.pad(F.col("px"), w)).select(
            "symbol",
            "date",
            F.col("px").isNull().alias("gap"),
            growth(p, F.lag(p, 1).over(w)).alias("ret_1d"),
            growth(p, F.lag(p, 5).over(w)).alias("ret_5d"),
        )
    )


@query(
    "w03_raw_return_on_adjusted_price",
    f"""WITH {s.BARS} SELECT * FROM (SELECT date AS decision_date, symbol,
      round(adj_close / lag(adj_close) OVER w - 1, 6) + 0.0 AS ret_1d_raw,
      round(lag(adj_close, 1) OVER w / lag(adj_close, 3) OVER w - 1, 6) + 0.0 AS ret_2d,
      lag(date) OVER w AS feature_available_date
      FROM bars WINDOW w AS (PARTITION BY symbol ORDER BY date)) WHERE feature_available_date IS NOT NULL""",
)
def _raw_return(spark, sf_dir):
    """Adjusted prices where the table has them, with the opt-in same-day return."""
    features = price_features.build_price_features(
        a.landed_bars(spark, sf_dir), adjusted=True, lookbacks=(2,), include_raw_return=True
    )
    return rounded(features.select("decision_date", "symbol", "ret_1d_raw", "ret_2d", "feature_available_date"))


@query(
    "p01_price_choice",
    f"""WITH {s.BARS}, {s.EVENT_BARS.replace('bars AS', 'ebars AS')}
    SELECT 'with_adjusted' AS source, count(*) AS n, round(avg(adj_close), 4) + 0.0 AS mean_px FROM bars
    UNION ALL SELECT 'adjusted_off', count(*), round(avg(close), 4) + 0.0 FROM bars
    UNION ALL SELECT 'adjusted_empty', count(*), round(avg(close), 4) + 0.0 FROM ebars""",
)
def _price_choice(spark, sf_dir):
    bars = a.landed_bars(spark, sf_dir)
    empty = a.event_bars(spark, sf_dir).withColumn("adj_close", F.lit(None).cast("double"))

    def summary(prices, adjusted, name):
        rows = price_features.priced_rows(prices, adjusted)
        return rows.agg(counted("n"), F.avg("px").alias("mean_px")).select(F.lit(name).alias("source"), "n", "mean_px")

    parts = summary(bars, True, "with_adjusted").unionByName(summary(bars, False, "adjusted_off"))
    return rounded(parts.unionByName(summary(empty, True, "adjusted_empty")), 4)


@query(
    "a01_j01_market_mean",
    f"""WITH {s.BARS} SELECT symbol, date,
    round(close / avg(close) OVER (PARTITION BY date), 6) + 0.0 AS px_to_market FROM bars""",
)
def _market_mean(spark, sf_dir):
    rows = price_features.priced_rows(a.landed_bars(spark, sf_dir), adjusted=False)
    joined = attach_daily(rows, price_features.market_price(rows), "date")
    return rounded(joined.select("symbol", "date", (F.col("px") / F.col("mkt_px")).alias("px_to_market")))


@query(
    "w12_a27_label_summary",
    f"""WITH {s.BARS}, {s.labels(20)} SELECT count(*) AS rows,
    avg(CASE WHEN future_return_20d IS NULL THEN 1.0 ELSE 0.0 END) AS nan_ratio FROM labels_h""",
)
def _label_summary(spark, sf_dir):
    built = labels.build_labels(a.landed_bars(spark, sf_dir), horizon=20)
    return labels.label_summary(built, "future_return_20d")


@query(
    "w12_forward_labels",
    f"WITH {s.BARS}, {s.labels(20)} SELECT decision_date, label_date, symbol, "
    f"{r6('future_return_20d')}, horizon FROM labels_h",
)
def _forward_labels(spark, sf_dir):
    return rounded(labels.build_labels(a.landed_bars(spark, sf_dir), horizon=20))


EARNINGS_SQL = f"""reports AS (
  SELECT CAST(l_suppkey AS VARCHAR) AS symbol, {s.bday('CAST(l_shipdate AS DATE)', 1)} AS decision_date,
         l_extendedprice * (1 - l_discount) - l_extendedprice * (1 - l_tax) AS surprise
  FROM lineitem WHERE l_linenumber = 1),
events_e AS (
  SELECT decision_date, symbol, 1.0::DOUBLE AS earnings_event, avg(surprise) AS eps_surprise FROM reports GROUP BY 1, 2)"""


@query(
    "a02_earnings_events",
    f"WITH {EARNINGS_SQL} SELECT decision_date, symbol, earnings_event, round(eps_surprise, 6) + 0.0 AS eps_surprise "
    "FROM events_e",
)
def _earnings_events(spark, sf_dir):
    return rounded(earnings_ops.earnings_events(a.earnings(spark, sf_dir), shift_days=1), 6)


@query(
    "j03_features_with_earnings",
    f"""WITH {s.BARS}, {s.features([5])}, {EARNINGS_SQL}
    SELECT decision_date, symbol, {r6('ret_5d')}, coalesce(earnings_event, 0.0) AS earnings_event,
           round(coalesce(eps_surprise, 0.0), 6) + 0.0 AS eps_surprise
    FROM feats LEFT JOIN events_e USING (decision_date, symbol)""",
)
def _features_with_earnings(spark, sf_dir):
    features = price_features.build_price_features(a.landed_bars(spark, sf_dir), lookbacks=(5,))
    joined = feature_store.with_earnings(
        features.select("decision_date", "symbol", "ret_5d"), a.earnings(spark, sf_dir), shift_days=1
    )
    return rounded(joined)


@query(
    "s02_features_laid_out_by_symbol",
    f"""WITH {s.BARS}, {s.features([1, 5, 20])}, {s.labels(5)}, {EARNINGS_SQL}
    SELECT decision_date, symbol, {r6('ret_1d', 'ret_5d', 'ret_20d', 'vol_20d', 'corr_mkt_20d')}, {r6('future_return_5d')}, label_date,
      coalesce(earnings_event, 0.0) AS earnings_event, round(coalesce(eps_surprise, 0.0), 6) + 0.0 AS eps_surprise
    FROM feats JOIN labels_h USING (decision_date, symbol) LEFT JOIN events_e USING (decision_date, symbol)""",
)
def _features_laid_out_by_symbol(spark, sf_dir):
    """Features, labels and earnings from two panels that are stored by symbol: no exchange by symbol after the write."""
    paths = [fresh_folder(spark, "panel") for _ in range(2)]
    panels.write_panel(a.landed_bars(spark, sf_dir), paths[0], buckets=16)
    panels.write_panel(earnings_ops.earnings_events(a.earnings(spark, sf_dir), shift_days=1), paths[1], buckets=16, sort_by=["decision_date"])
    bars, events = (panels.attach_panel(spark, path) for path in paths)
    features = price_features.build_price_features(bars, lookbacks=(1, 5, 20), label_horizon=5)
    joined = fill_zero(panels.with_daily_events(features, events), ["earnings_event", "eps_surprise"])
    return rounded(
        joined.select(
            "decision_date", "symbol", "ret_1d", "ret_5d", "ret_20d", "vol_20d", "corr_mkt_20d", "future_return_5d", "label_date",
            "earnings_event", "eps_surprise",
        )
    )


@query(
    "s09_incremental_price_features",
    f"WITH {s.BARS}, {s.features(list(LOOKBACKS))} SELECT decision_date, symbol, "
    f"{r6(*[c for c in FEATURE_COLUMNS if c != 'adv20_dollar'])}, round(ln(adv20_dollar), 6) + 0.0 AS ln_adv20_dollar, "
    "feature_available_date FROM feats",
)
def _incremental_price_features(spark, sf_dir):
    """Features of a store that got its bars in four lots; the last has bars that come half a year late."""
    bars, (prices, store) = a.landed_bars(spark, sf_dir), [fresh_folder(spark, n) for n in ("prices", "features")]
    day = F.col("date")
    late = (F.pmod(F.xxhash64("symbol"), F.lit(5)) == 0) & day.between("1997-11-10", "1997-12-20")
    lots = [(day < "1997-06-01"), day.between("1997-06-01", "1998-05-31") & ~late, (day >= "1998-06-01") & (day < "1998-06-20"), (day >= "1998-06-20") | late]
    for lot in lots:
        incremental.add_bars(spark, bars.where(lot), prices, store, lookbacks=LOOKBACKS)
    return rounded(incremental.stored_features(spark, store).withColumn("ln_adv20_dollar", F.ln("adv20_dollar")).drop("adv20_dollar"))


STATEMENTS = {"revenue": ("income", "revenue"), "assets": ("balance", "assets"), "debt": ("balance", "debt")}


@query(
    "j07_statements_as_of",
    f"""WITH {s.BARS},
    st AS (SELECT CAST(l_suppkey AS VARCHAR) AS symbol, {s.bday('CAST(l_shipdate AS DATE)', 2)} AS known_from, l_returnflag AS flag,
      l_extendedprice AS price, CASE WHEN l_quantity > 5 THEN l_quantity END AS quantity, l_tax AS tax FROM lineitem WHERE l_linenumber = 1),
    income AS (SELECT symbol, known_from, max(price) AS revenue FROM st WHERE flag = 'A' GROUP BY ALL),
    balance AS (SELECT symbol, known_from, max(ROW(coalesce(quantity, -1), tax)) AS r FROM st WHERE flag = 'R' GROUP BY ALL)
    SELECT b.symbol, b.date AS decision_date, round(i.revenue, 2) + 0.0 AS revenue, CASE WHEN c.r[1] >= 0 THEN round(c.r[1], 2) + 0.0 END AS assets,
      round(c.r[2], 2) + 0.0 AS debt, date_diff('day', greatest(i.known_from, c.known_from), b.date)::INTEGER AS statement_age
    FROM bars b ASOF LEFT JOIN income i ON b.symbol = i.symbol AND b.date >= i.known_from ASOF LEFT JOIN balance c ON b.symbol = c.symbol AND b.date >= c.known_from""",
)
def _statements_as_of(spark, sf_dir):
    """Bars with the figures of the last statements published two business days before or earlier."""
    lines = a.table(spark, sf_dir, "lineitem").filter("l_linenumber = 1").withColumn("symbol", F.col("l_suppkey").cast("string"))

    def of(flag, *columns):
        return lines.filter(F.col("l_returnflag") == flag).select("symbol", F.col("l_shipdate").alias("fillingDate"), *columns)

    assets = F.when(F.col("l_quantity") > 5, F.col("l_quantity")).alias("assets")
    statements = store.tag_and_stack(
        {"income": of("A", F.col("l_extendedprice").alias("revenue")), "balance": of("R", assets, F.col("l_tax").alias("debt"))}
    )
    panel = a.landed_bars(spark, sf_dir).select("symbol", F.col("date").alias("decision_date"))
    return rounded(asof.with_statements(panel, statements, STATEMENTS, shift_days=2), 2)


def _days(spark, sf_dir):
    """First and last bar of the test data."""
    span = a.table(spark, sf_dir, "lineitem").agg(
        F.min(F.to_date("l_shipdate")).alias("a"), F.max(F.to_date("l_shipdate")).alias("b")
    ).first()
    return span["a"], span["b"]


@query(
    "j02_members_only",
    f"""WITH {s.BARS}, {s.features([5])} SELECT decision_date, symbol, {r6('ret_5d')}, feature_available_date
    FROM feats WHERE isodow(decision_date) < 6""",
)
def _members_only(spark, sf_dir):
    """Features on days the symbol is in a static universe."""
    bars = a.landed_bars(spark, sf_dir)
    features = price_features.build_price_features(bars, lookbacks=(5,))
    suppliers = a.table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("symbol"))
    kept = feature_store.members_only(features, static_spans(suppliers, *_days(spark, sf_dir)))
    return rounded(kept.select("decision_date", "symbol", "ret_5d", "feature_available_date"))


@query(
    "j06_labelled_members",
    f"""WITH {s.BARS}, {s.features([1])}, {s.labels(20)} SELECT decision_date, symbol, {r6('ret_1d')}, label_date,
    {r6('future_return_20d')} FROM feats JOIN labels_h USING (decision_date, symbol) WHERE isodow(decision_date) < 6""",
)
def _labelled_members(spark, sf_dir):
    bars = a.landed_bars(spark, sf_dir)
    suppliers = a.table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("symbol"))
    features = price_features.build_price_features(bars, lookbacks=(1,), label_horizon=20)
    kept = feature_store.members_only(features, static_spans(suppliers, *_days(spark, sf_dir)))
    return rounded(kept.select("decision_date", "symbol", "ret_1d", "label_date", "future_return_20d"))


# --- news ---------------------------------------------------------------------------------------

def sentiment_sql(text_sql: str, positive, negative) -> str:
    words = f"regexp_extract_all(lower({text_sql}), '[a-z'']+')"

    def hits(lexicon):
        names = ", ".join(f"'{w}'" for w in lexicon)
        return f"len([x FOR x IN {words} IF x IN ({names})])"

    return f"(({hits(positive)} - {hits(negative)})::DOUBLE / nullif(len({words}), 0))"


NEWS_SQL = f"""raw AS (
  SELECT event_id, user_id, event_type, ts, json_extract_string(props, '$.k') AS site,
         event_type || ' beats weak ' || event_type AS title FROM events),
art AS (
  SELECT event_id, {s.bday('CAST(ts AS DATE)', 1)} AS decision_date, coalesce(site, 'unknown') AS source,
         {sentiment_sql('title', a.EVENT_POSITIVE, a.EVENT_NEGATIVE)} AS score,
         CASE WHEN event_type = 'error' THEN ['GENERAL']
              WHEN event_type = 'view' THEN ['U' || user_id, 'U' || (user_id + 1), 'BAD', 'NAME']
              ELSE ['U' || user_id] END AS symbols
  FROM raw),
by_market AS (
  SELECT decision_date, count(*) AS mkt_news_count_1d, avg(score) AS mkt_news_sent_mean_1d FROM art GROUP BY 1),
by_symbol AS (
  SELECT decision_date, symbol, count(*) AS news_count_1d, avg(score) AS news_sent_mean_1d,
         count(DISTINCT source) AS news_source_nuniq_1d
  FROM (SELECT decision_date, unnest(symbols) AS symbol, score, source FROM art) GROUP BY 1, 2)"""


def _groups(spark, sf_dir):
    return news.story_groups(
        a.articles(spark, sf_dir), shift_days=1, positive=a.EVENT_POSITIVE, negative=a.EVENT_NEGATIVE
    )


@query(
    "a03_f08_news_by_symbol",
    f"WITH {NEWS_SQL} SELECT decision_date, symbol, news_count_1d, {r6('news_sent_mean_1d')}, news_source_nuniq_1d "
    "FROM by_symbol",
)
def _news_by_symbol(spark, sf_dir):
    return rounded(news.news_by_symbol(_groups(spark, sf_dir)))


@query(
    "a04_news_by_market",
    f"WITH {NEWS_SQL} SELECT decision_date, mkt_news_count_1d, {r6('mkt_news_sent_mean_1d')} FROM by_market",
)
def _news_by_market(spark, sf_dir):
    return rounded(news.news_by_market(_groups(spark, sf_dir)))


@query(
    "f08_general_news_to_tickers",
    f"""WITH tagged AS (SELECT {s.bday('CAST(ts AS DATE)', 2)} AS decision_date,
      unnest(CASE WHEN event_type IN ('view', 'error') THEN ['U' || user_id, 'U' || (user_id + 1), 'BAD', 'NAME']
                  ELSE ['U' || user_id] END) AS symbol FROM events)
    SELECT decision_date, symbol, count(*) AS news_count_1d FROM tagged GROUP BY 1, 2""",
)
def _general_to_tickers(spark, sf_dir):
    """F8 with the option that market placeholders give way to the ticker list."""
    groups = news.story_groups(a.articles(spark, sf_dir), shift_days=2, use_tickers_for_general=True)
    return news.news_by_symbol(groups).select("decision_date", "symbol", "news_count_1d")


NEWS_FEATURES = [
    "news_count_1d", "news_sent_mean_1d", "news_source_nuniq_1d", "mkt_news_count_1d", "mkt_news_sent_mean_1d",
    "news_count_5d", "news_count_20d", "news_sent_mean_5d", "news_sent_std_20d", "mkt_news_count_20d",
    "mkt_news_sent_mean_5d", "news_attention_20d",
]


@query(
    "news_features",
    f"""WITH {s.EVENT_BARS}, {s.features([1, 2])}, {NEWS_SQL},
    base AS (
      SELECT f.decision_date, f.symbol, ret_1d, ret_2d,
        coalesce(news_count_1d, 0)::DOUBLE AS news_count_1d, coalesce(news_sent_mean_1d, 0.0) AS news_sent_mean_1d,
        coalesce(news_source_nuniq_1d, 0)::DOUBLE AS news_source_nuniq_1d,
        coalesce(mkt_news_count_1d, 0)::DOUBLE AS mkt_news_count_1d,
        coalesce(mkt_news_sent_mean_1d, 0.0) AS mkt_news_sent_mean_1d
      FROM feats f LEFT JOIN by_symbol USING (decision_date, symbol) LEFT JOIN by_market USING (decision_date)
      WHERE isodow(f.decision_date) < 6),
    rolled AS (
      SELECT *, sum(news_count_1d) OVER w5 AS news_count_5d, sum(news_count_1d) OVER w20 AS news_count_20d,
        avg(news_sent_mean_1d) OVER w5 AS news_sent_mean_5d,
        coalesce(stddev_samp(news_sent_mean_1d) OVER w20, 0.0) AS news_sent_std_20d,
        sum(mkt_news_count_1d) OVER w20 AS mkt_news_count_20d,
        avg(mkt_news_sent_mean_1d) OVER w5 AS mkt_news_sent_mean_5d
      FROM base WINDOW w5 AS (PARTITION BY symbol ORDER BY decision_date ROWS 4 PRECEDING),
                       w20 AS (PARTITION BY symbol ORDER BY decision_date ROWS 19 PRECEDING)),
    done AS (SELECT *, news_count_20d / (mkt_news_count_20d + 1e-12) AS news_attention_20d FROM rolled)
    SELECT decision_date, symbol, {r6('ret_1d', 'ret_2d', *NEWS_FEATURES)} FROM done""",
)
def _news_features(spark, sf_dir):
    """members' features with rolled symbol and market news."""
    bars = a.landed_event_bars(spark, sf_dir)
    weekdays = bars.filter(dates.is_business_day(F.col("date"))).select(
        "date", "symbol", F.lit(True).alias("is_member")
    )
    features = feature_store.build_feature_store(
        prices=bars,
        membership=weekdays,
        news=a.articles(spark, sf_dir),
        lookbacks=(1, 2),
        positive=a.EVENT_POSITIVE,
        negative=a.EVENT_NEGATIVE,
    )
    return rounded(features.select("decision_date", "symbol", "ret_1d", "ret_2d", *NEWS_FEATURES))


@query(
    "f04_text_sentiment",
    f"""SELECT doc_id, round({sentiment_sql('text', a.PROSE_POSITIVE, a.PROSE_NEGATIVE)}, 6) + 0.0 AS sentiment
    FROM documents""",
)
def _text_sentiment(spark, sf_dir):
    score = text.sentiment(text.join_text(F.col("text")), a.PROSE_POSITIVE, a.PROSE_NEGATIVE)
    return rounded(a.table(spark, sf_dir, "documents").select("doc_id", score.alias("sentiment")))


@query(
    "f05_conversation_sentiment",
    f"""SELECT conv_id, turn, round({sentiment_sql("coalesce(role, '') || ' ' || coalesce(text, '')", a.PROSE_POSITIVE, a.PROSE_NEGATIVE)}, 6) + 0.0
    AS sentiment FROM conversations""",
)
def _conversation_sentiment(spark, sf_dir):
    rows = a.table(spark, sf_dir, "conversations").withColumnRenamed("role", "title")
    score = news.article_sentiment(rows, a.PROSE_POSITIVE, a.PROSE_NEGATIVE)
    return rounded(rows.select("conv_id", "turn", score.alias("sentiment")))


TICKER_TEXT_SQL = """c_name || ',' || lower(c_mktsegment) || ':c' || c_custkey || ' | all;' || 'N/A nyse:brk.b\\c' || c_custkey
    || ',too-long-for-a-ticker'"""


@query(
    "f06_f07_ticker_lists",
    """SELECT c_custkey, array_to_string(['C' || c_custkey, 'N', 'A', 'BRK.B'], '+') AS tickers,
    'C' || c_custkey AS first_ticker, 'GENERAL' AS fallback FROM customer""",
)
def _ticker_lists(spark, sf_dir):
    """messy lists to clean tickers; names, long tokens and placeholders drop out."""
    key = F.col("c_custkey").cast("string")
    messy = F.concat(
        F.col("c_name"), F.lit(","), F.lower("c_mktsegment"), F.lit(":c"), key, F.lit(" | all;N/A nyse:brk.b\\c"), key,
        F.lit(",too-long-for-a-ticker"),
    )
    return a.table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.array_join(text.tickers(messy, drop_placeholders=True), "+").alias("tickers"),
        text.first_ticker(messy).alias("first_ticker"),
        text.first_ticker(F.col("c_name")).alias("fallback"),
    )


@query(
    "f01_business_day_add",
    f"""SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d,
    {s.bday('CAST(o_orderdate AS DATE)', 1)} AS plus_1, {s.bday('CAST(o_orderdate AS DATE)', 4)} AS plus_4,
    {s.bday('CAST(o_orderdate AS DATE)', 7)} AS plus_7,
    CASE WHEN isodow(o_orderdate) < 6 THEN CAST(o_orderdate AS DATE)
         ELSE {s.bday('CAST(o_orderdate AS DATE)', 1)} END AS plus_0 FROM orders""",
)
def _business_day_add(spark, sf_dir):
    d = F.to_date("o_orderdate")
    moved = {f"plus_{n}": dates.add_business_days(d, n) for n in (0, 1, 4, 7)}
    return a.table(spark, sf_dir, "orders").select("o_orderkey", d.alias("d"), *[c.alias(n) for n, c in moved.items()])


@query(
    "f02_f03_business_calendar",
    """SELECT date, isoyear(date) * 100 + week(date) AS iso_week FROM (
      SELECT CAST(unnest(generate_series(min(o_orderdate), max(o_orderdate), INTERVAL 1 DAY)) AS DATE) AS date FROM orders)
    WHERE isodow(date) < 6""",
)
def _business_calendar(spark, sf_dir):
    span = a.table(spark, sf_dir, "orders").agg(
        F.to_date(F.min("o_orderdate")).alias("a"), F.to_date(F.max("o_orderdate")).alias("b")
    )
    days = span.select(F.explode(dates.business_days(F.col("a"), F.col("b"))).alias("date"))
    return days.select("date", dates.iso_week(F.col("date")).cast("long").alias("iso_week"))


@query(
    "f12_scalar_functions",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice,
      CASE WHEN l_discount > 0 THEN round(ln(l_discount), 6) + 0.0 END AS ln_discount,
      round(abs(l_tax - l_discount), 6) + 0.0 AS gap, nullif(l_tax, 0) AS tax,
      round(l_discount / nullif(l_tax, 0), 6) + 0.0 AS discount_per_tax,
      round(least(1.0, greatest(-1.0, l_quantity / 25.0 - 1.0)), 6) + 0.0 AS clipped FROM lineitem""",
)
def _scalar_functions(spark, sf_dir):
    from panelkiln.functions.numeric import clip, log, ratio, zero_as_null

    d, t = number("l_discount"), number("l_tax")
    return rounded(
        a.table(spark, sf_dir, "lineitem").select(
            "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice",
            log(d).alias("ln_discount"),
            F.abs(t - d).alias("gap"),
            zero_as_null(t).alias("tax"),
            ratio(d, t).alias("discount_per_tax"),
            clip(F.col("l_quantity") / 25.0 - 1.0, -1.0, 1.0).alias("clipped"),
        )
    )
