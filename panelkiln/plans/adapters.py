"""Panel-shaped inputs derived from the generic test tables.

The test data holds no market prices. ``lineitem`` gives bars (supplier = symbol,
ship date = day, unit price = price), ``events`` give short bars and news,
``orders`` give index changes and sweep results.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from panelkiln.session import fresh_folder
from panelkiln.sources.tables import read_table


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, f"{sf_dir}/{name}.parquet")


def _bars(rows: DataFrame, order: list[str]) -> DataFrame:
    """Bars from (symbol, date, u, q, d) rows, dealt by symbol and day, so that the rows are sorted once, after they moved.

    First and last row are aggregates that Spark sorts for. Combining map-side would sort every map task's rows before the
    shuffle too, and gains nothing as few rows share a key; a busy symbol is dealt by its days.
    """
    at = F.struct(*order, "u")
    rows = rows.select("symbol", "date", "u", "q", "d", *[c for c in order if c != "u"]).repartition("symbol", "date")
    close = F.max(at)["u"]
    return rows.groupBy("symbol", "date").agg(
        F.min(at)["u"].alias("open"),
        F.max("u").alias("high"),
        F.min("u").alias("low"),
        close.alias("close"),
        (close * (F.lit(1.0) - F.avg("d"))).alias("adj_close"),
        F.sum("q").alias("volume"),
    )


def _lines(lineitem: DataFrame) -> DataFrame:
    return lineitem.select(
        F.col("l_suppkey").cast("string").alias("symbol"),
        F.to_date("l_shipdate").alias("date"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("u"),
        F.col("l_quantity").alias("q"),
        F.col("l_discount").alias("d"),
        "l_orderkey", "l_linenumber", "l_returnflag",
    )


LINE_ORDER = ["l_orderkey", "l_linenumber"]


def bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily bars per supplier, keyed by (symbol, date)."""
    return _bars(_lines(table(spark, sf_dir, "lineitem")), LINE_ORDER)


_LANDED: dict[tuple, str] = {}


def _stamp(spark: SparkSession, sf_dir: str) -> tuple:
    """Sizes and times of the tables' files: what is landed again when the data behind it change."""
    out = []
    for name in ("lineitem", "events"):
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{sf_dir}/{name}.parquet")
        system = path.getFileSystem(spark._jsc.hadoopConfiguration())
        for status in system.listStatus(path):
            out.append((status.getPath().getName(), status.getLen(), status.getModificationTime()))
    return tuple(sorted(out))


def _landed(spark: SparkSession, sf_dir: str, build: Callable[[SparkSession, str], DataFrame]) -> DataFrame:
    """A price table as stored on disk: landing is a step of its own, done once per session and data folder."""
    key = (spark.sparkContext.applicationId, sf_dir, build.__name__, _stamp(spark, sf_dir))
    if key in _LANDED:
        try:
            return read_table(spark, _LANDED[key])
        except AnalysisException as error:
            # The folder was emptied meanwhile: land the prices again.
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
    path = fresh_folder(spark, build.__name__)
    # Bars come dealt by symbol and day and in their order: files are even without another shuffle.
    build(spark, sf_dir).sortWithinPartitions("symbol", "date").write.parquet(path)
    _LANDED[key] = path
    return read_table(spark, path)


def landed_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``bars`` as the stored price table that features are built from."""
    return _landed(spark, sf_dir, bars)


def landed_event_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _landed(spark, sf_dir, event_bars)


def bars_by_flag(spark: SparkSession, sf_dir: str, returned: bool) -> DataFrame:
    """Bars of the returned lines, or of all the others: two overlapping halves of one table."""
    lines = _lines(table(spark, sf_dir, "lineitem"))
    return _bars(lines.filter((F.col("l_returnflag") == "R") == F.lit(returned)), LINE_ORDER)


def returned_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every returned line as a price row, with its place in the feed as ``arrival``."""
    u = F.col("u")
    return _lines(table(spark, sf_dir, "lineitem")).filter("l_returnflag = 'R'").select(
        "symbol", "date", *[u.alias(c) for c in ("open", "high", "low", "close")],
        (u * (F.lit(1.0) - F.col("d"))).alias("adj_close"), F.col("q").alias("volume"),
        F.struct("l_orderkey", "l_linenumber").alias("arrival"),
    )


def line_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line as a price row: keys repeat, as in a raw feed."""
    u = F.col("u")
    return _lines(table(spark, sf_dir, "lineitem")).select(
        "symbol",
        "date",
        (u * (F.lit(1.0) - F.col("d"))).alias("open"),
        F.when(F.col("q") <= 45, u).alias("high"),
        (u * F.lit(0.95)).alias("low"),
        F.when(F.col("q") > 1, u).alias("close"),
        F.when(F.col("q") > 2, u * (F.lit(1.0) - F.col("d"))).alias("adj_close"),
        F.when(F.col("q") <= 25, F.lit(0.0)).when(F.col("q") < 50, F.col("q")).alias("volume"),
    )


def event_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily bars per user over the event values."""
    rows = table(spark, sf_dir, "events").select(
        F.concat(F.lit("U"), F.col("user_id").cast("string")).alias("symbol"),
        F.to_date("ts").alias("date"),
        F.col("value").alias("u"),
        F.lit(1.0).alias("q"),
        F.lit(0.0).alias("d"),
        "ts", "event_id",
    )
    return _bars(rows, ["ts", "event_id"])


def earnings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First lines of orders as earnings reports."""
    return table(spark, sf_dir, "lineitem").filter("l_linenumber = 1").select(
        F.col("l_shipdate").alias("date"),
        F.col("l_suppkey").cast("string").alias("symbol"),
        (F.col("l_extendedprice") * (F.lit(1.0) - F.col("l_discount"))).alias("eps"),
        (F.col("l_extendedprice") * (F.lit(1.0) - F.col("l_tax"))).alias("epsEstimated"),
    )


def actions(spark: SparkSession, sf_dir: str, line: int) -> DataFrame:
    """Returned lines of one line number as corporate actions."""
    return table(spark, sf_dir, "lineitem").filter(
        (F.col("l_returnflag") == "R") & (F.col("l_linenumber") == line)
    ).select(
        F.to_date("l_shipdate").alias("date"),
        F.col("l_suppkey").cast("string").alias("symbol"),
        F.col("l_quantity").alias("amount"),
    )


def index_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as index changes: open ones add the customer, filled ones remove it, partial ones swap."""
    name = F.concat(F.lit("C"), F.col("o_custkey").cast("string"))
    other = F.concat(F.lit("C"), F.floor(F.col("o_custkey") / 2).cast("string"))
    status = F.col("o_orderstatus")
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderdate").alias("date"),
        F.col("o_orderkey").alias("seq"),
        F.when(status.isin("O", "P"), name).alias("added"),
        F.when(status == "F", name).when(status == "P", other).alias("removed"),
    )


def index_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers in credit are the members of today."""
    return table(spark, sf_dir, "customer").filter("c_acctbal > 0").select(
        F.concat(F.lit("C"), F.col("c_custkey").cast("string")).alias("symbol")
    )


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as news: errors concern the market, views name their symbols in a ticker list."""
    kind, user = F.col("event_type"), F.col("user_id").cast("string")
    return table(spark, sf_dir, "events").select(
        F.when(kind != "signup", F.col("ts").cast("string")).alias("publishedDate"),
        F.col("ts").cast("string").alias("date"),
        F.when(kind == "error", F.lit("GENERAL")).when(kind != "view", F.concat(F.lit("u"), user)).alias("symbol"),
        F.concat(
            F.lit("X:U"), user, F.lit(", y:u"), (F.col("user_id") + 1).cast("string"), F.lit("/all|Bad Name Incorporated")
        ).alias("tickers"),
        F.concat_ws(" ", kind, F.lit("beats weak"), kind).alias("title"),
        F.get_json_object("props", "$.k").alias("site"),
    )


# Words that stand in for a sentiment lexicon in the test data.
EVENT_POSITIVE = ("purchase", "signup", "beats")
EVENT_NEGATIVE = ("error", "weak")
PROSE_POSITIVE = ("and", "der", "la", "of", "the")
PROSE_NEGATIVE = ("die", "is", "le", "on", "un")


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as sweep runs: period = year, candidate = priority and status."""
    price = F.col("o_totalprice")
    return table(spark, sf_dir, "orders").select(
        F.year("o_orderdate").cast("string").alias("end_date"),
        F.concat_ws("/", "o_orderpriority", "o_orderstatus").alias("name"),
        F.col("o_orderkey").alias("seq"),
        F.when(price > 20000, price / 1000.0).alias("score"),
        (price / 1000000.0).alias("rank_ic_test_mean"),
        (price / 100000.0).alias("sharpe"),
        (price / 200000.0 - 1.0).alias("total_return"),
        (-price / 500000.0).alias("max_drawdown"),
        F.when(price > 5000, price / 10000000.0).alias("avg_cost"),
        (price > 1500).alias("ops_gate_ok"),
        F.array((F.col("o_custkey") % 7).cast("int"), F.lit(20)).alias("lookbacks"),
        F.when(F.col("o_orderstatus") != "P", F.lit(1)).otherwise(F.lit(2)).alias("event_shift"),
    )
