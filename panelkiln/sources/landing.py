"""Landed vendor JSON: files of ``{"meta": {...}, "data": [...]}``.

Payloads are read as text and values are coerced later, so that a number written
as text is a number, and a file that is no JSON is told from an empty payload.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from panelkiln.functions.dates import day
from panelkiln.functions.numeric import number

META = "struct<timestamp:string,status_code:string,endpoint_name:string,symbol:string,cache_key:string>"
PRICE_FIELDS = ("date", "open", "high", "low", "close", "adjClose", "adj_close", "unadjustedClose", "volume")
PRICE_COLUMNS = ("open", "high", "low", "close", "adj_close", "volume")
BROKEN = "_corrupt_record"


def envelope_schema() -> StructType:
    return StructType.fromDDL(f"meta {META}, data string, {BROKEN} string")


def read_landing(spark: SparkSession, path: str, *, one_per_file: bool = False) -> DataFrame:
    """Envelopes below ``path``: one per line, or one per file however it is laid out.

    The schema is given, not inferred, so the files are read once. What is no
    JSON stays, as text in ``_corrupt_record``.
    """
    return spark.read.schema(envelope_schema()).option("multiLine", one_per_file).json(path)


def broken_files(envelopes: DataFrame) -> DataFrame:
    """(file, text, data) of what could not be read; ``data`` is what was."""
    named = envelopes.select(F.col("_metadata.file_path").alias("file"), F.col(BROKEN).alias("text"), "data")
    return named.filter("text is not null")


def _entries(envelopes: DataFrame, kind: str) -> Column:
    """The payload as an array; NULL when it is no list. Fails on a broken file, rather than lose it."""
    text = F.when(F.ltrim("data").startswith("["), F.from_json("data", f"array<{kind}>"))
    if BROKEN not in envelopes.columns:
        return text
    said = F.concat(F.lit("unreadable landing file: "), F.substring(BROKEN, 1, 200))
    return F.when(F.col(BROKEN).isNotNull(), F.raise_error(said).cast(f"array<{kind}>")).otherwise(text)


def payload_rows(envelopes: DataFrame, fields: Sequence[str]) -> DataFrame:
    """One row per payload entry with these fields as text, stamped with the symbol; empty payloads give none."""
    kind = "struct<" + ",".join(f"`{f}`:string" for f in fields) + ">"
    return envelopes.select(F.col("meta.symbol").alias("_symbol"), F.inline(_entries(envelopes, kind)))


def vendor_fields(envelopes: DataFrame) -> list[str]:
    """Names of all fields that any entry has, sorted: a vendor's schema, which doesn't grow with its rows."""
    keys = envelopes.select(F.explode(_entries(envelopes, "map<string,string>")).alias("m"))
    return sorted(r[0] for r in keys.select(F.explode(F.map_keys("m"))).distinct().collect())


def landed_rows(envelopes: DataFrame, fields: Sequence[str] | None = None) -> DataFrame:
    """Entries of any payload (dividends, splits, earnings, statements, news) with all vendor fields as text.

    An entry's own symbol stays; one without gets that of its envelope.
    """
    names = list(fields) if fields is not None else vendor_fields(envelopes)
    rows = payload_rows(envelopes, names)
    symbol = F.coalesce("symbol", "_symbol") if "symbol" in names else F.col("_symbol")
    return rows.select(symbol.alias("symbol"), *[F.col(f"`{n}`") for n in names if n != "symbol"])


def landed_prices(envelopes: DataFrame) -> DataFrame:
    """Typed (date, symbol, open, high, low, close, adj_close, volume) rows. A date that can't be read is an error."""
    rows = payload_rows(envelopes, PRICE_FIELDS).withColumn("adj_close", F.coalesce("adjClose", "adj_close"))
    said = F.concat(F.lit("unreadable price date: "), F.col("date"))
    dated = F.when(F.col("date").isNotNull() & day("date").isNull(), F.raise_error(said).cast("date")).otherwise(day("date"))
    return rows.select(dated.alias("date"), F.col("_symbol").alias("symbol"), *[number(c).alias(c) for c in PRICE_COLUMNS])


def as_envelopes(rows: DataFrame, endpoint: str = "prices_eod") -> DataFrame:
    """Dated rows as landing envelopes, one per symbol and year (so at most 366 entries for keyed rows)."""
    own = [F.col(c).alias("adjClose" if c == "adj_close" else c) for c in rows.columns if c not in ("date", "symbol")]
    row = F.struct(F.col("date").cast("string").alias("date"), *own)
    meta = F.struct(F.lit(200).alias("status_code"), F.lit(endpoint).alias("endpoint_name"), "symbol")
    # Dealt first, so that rows are sorted once for their lists and not before the shuffle too.
    dealt = rows.withColumn("_year", F.year("date")).repartition("symbol", "_year")
    return (
        dealt.groupBy("symbol", "_year")
        .agg(F.array_sort(F.collect_list(row)).alias("data"))
        .select(meta.alias("meta"), "data")
    )
