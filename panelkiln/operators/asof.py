"""As-of joins: what was known last when a row was taken."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from panelkiln.functions.columns import first_value, require, symbol_name
from panelkiln.functions.dates import add_business_days, day
from panelkiln.functions.numeric import number

SLICE_DAYS = 366

#: Vendor columns for the day a statement was published; the first that a row has is used.
PUBLISHED = ("acceptedDate", "fillingDate", "filingDate", "date")

_DAY = 86_400_000_000


def _micros(time: str) -> Column:
    """Microseconds since 1970 of a date or timestamp."""
    return F.unix_micros(F.col(time).cast("timestamp"))


def asof_join(
    left: DataFrame,
    right: DataFrame,
    *,
    by: Sequence[str],
    left_time: str,
    right_time: str,
    columns: Sequence[str],
    matched_time: str | None = None,
    equal: bool = True,
    max_age_days: int | None = None,
    slice_days: int = SLICE_DAYS,
) -> DataFrame:
    """Every row of ``left`` with ``columns`` of the last row of ``right`` under the same keys that is not later.

    With ``equal=False`` it has to be earlier. Of right rows at one time that of the greatest values counts. Matches older
    than ``max_age_days`` are left out, as where there is none: the columns are NULL. NULL keys or times match nothing. ``matched_time``
    names a column for the time of the match. Repeated left rows stay repeated.

    Both sides become one time line, whose rows carry the last right row forward: one exchange, and no pairs. A
    line is cut into slices of ``slice_days``, so a key that holds much of a table is many groups; what each slice starts with
    comes from an aggregate with a row for each key and slice.
    """
    keys = list(by)
    match = F.struct(_micros(right_time).alias("at"), *[F.col(c) for c in columns])
    known = right.select(*keys, match.alias("match")).where(F.col("match.at").isNotNull()).dropna(subset=keys)
    # Copies and rows of one time collapse before any window.
    known = known.groupBy(*keys, F.col("match.at").alias("at")).agg(F.max("match").alias("match"))
    cut = lambda c: F.floor(F.col(c) / F.lit(_DAY * slice_days))
    known = known.withColumn("slice", cut("at"))
    row = F.struct(*[F.col(f"`{c}`") for c in left.columns]).alias("row")
    rows = left.select(*[F.col(k).alias(k) for k in keys], _micros(left_time).alias("at"), row).withColumn("slice", cut("at"))
    lacking = reduce(lambda x, y: x | y, [F.col(c).isNull() for c in [*keys, "at"]])
    asked = rows.where(~lacking)

    last = known.groupBy(*keys, "slice").agg(F.max_by("match", "at").alias("last"), F.lit(0).alias("asked"))
    wanted = asked.groupBy(*keys, "slice").agg(F.lit(None).cast(known.schema["match"].dataType).alias("last"), F.lit(1).alias("asked"))
    slices = last.union(wanted).groupBy(*keys, "slice").agg(F.max("last").alias("last"), F.max("asked").alias("asked"))
    before = Window.partitionBy(*keys).orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    seeds = slices.withColumn("match", F.last("last", ignorenulls=True).over(before)).where((F.col("asked") == 1) & F.col("match").isNotNull())

    nothing = F.lit(None)
    line = (
        seeds.select(*keys, "slice", nothing.cast("long").alias("at"), F.lit(0).alias("kind"), "match", nothing.cast(asked.schema["row"].dataType).alias("row"))
        .union(known.select(*keys, "slice", "at", F.lit(1 if equal else 3), "match", nothing.cast(asked.schema["row"].dataType)))
        .union(asked.select(*keys, "slice", "at", F.lit(2), nothing.cast(known.schema["match"].dataType), "row"))
    )
    # A NULL time sorts first: the seed of a slice.
    upto = Window.partitionBy(*keys, "slice").orderBy("at", "kind").rowsBetween(Window.unboundedPreceding, 0)
    found = line.withColumn("found", F.last("match", ignorenulls=True).over(upto)).where("kind = 2").select("at", "row", "found")
    # Rows that can't match needn't be dealt or ordered, however many they are.
    found = found.union(rows.where(lacking).select("at", "row", nothing.cast(known.schema["match"].dataType)))
    if max_age_days is not None:
        found = found.withColumn("found", F.when(F.col("at") - F.col("found.at") <= F.lit(_DAY * max_age_days), F.col("found")))
    time_type = right.schema[right_time].dataType
    time = [F.timestamp_micros("found.at").cast(time_type).alias(matched_time)] if matched_time else []
    return found.select("row.*", *time, *[F.col(f"found.{c}").alias(c) for c in columns])


def with_statements(
    panel: DataFrame,
    statements: DataFrame,
    values: Mapping[str, tuple[str, str]],
    *,
    shift_days: int = 1,
    max_age_days: int | None = None,
) -> DataFrame:
    """Panel rows with figures of the last statements published by then.

    ``statements`` are the stacked tables of ``tag_and_stack``; ``values`` maps a new column to (statement_type, figure). A statement counts
    from ``shift_days`` business days after it was published, by the first of ``PUBLISHED`` that it has. Statements of a type follow
    each other as wholes: a figure missing in the last one is missing. ``statement_age`` is the days since the last of any.
    """
    require(statements, "symbol", "statement_type")
    published = first_value(statements, PUBLISHED, day, "date")
    typed = statements.select(
        symbol_name("symbol").alias("symbol"),
        add_business_days(published, shift_days).alias("known_from"),
        "statement_type",
        *[F.when(F.col("statement_type") == kind, number(figure)).alias(name) for name, (kind, figure) in values.items()],
    )
    out = panel
    for kind in sorted({kind for kind, _ in values.values()}):
        names = [name for name, (k, _) in values.items() if k == kind]
        own = typed.where(F.col("statement_type") == kind)
        out = asof_join(
            out, own, by=["symbol"], left_time="decision_date", right_time="known_from", columns=names, matched_time=f"_from_{kind}", max_age_days=max_age_days
        )
    ages = [f"_from_{kind}" for kind in {kind for kind, _ in values.values()}]
    newest = F.greatest(*ages) if len(ages) > 1 else F.col(ages[0])
    return out.withColumn("statement_age", F.datediff("decision_date", newest)).drop(*ages)
