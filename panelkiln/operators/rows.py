"""Keyed row selection and joins that stay balanced under hot keys."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from panelkiln.session import stored


def _pick(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], last: bool) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    if rest and all(isinstance(c, str) for c in order) and set(rest) <= set(order):
        # The order holds the whole row: it need not travel twice.
        row = F.struct(*[c for c in order if c not in keys])
        return df.groupBy(*keys).agg((F.max if last else F.min)(row).alias("_row")).select(*keys, *[F.col(f"_row.`{c}`") for c in rest])
    rank = F.struct(*order)
    take = F.max_by if last else F.min_by
    return df.groupBy(*keys).agg(take(F.struct(*rest), rank).alias("_row")).select(*keys, "_row.*")


def keep_last(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """One row per key: the greatest by ``order``.

    An aggregate rather than a window, so copies collapse before the shuffle
    and a key that holds much of the table is no burden to one task.
    """
    return _pick(df, keys, order, last=True)


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """One row per key: the least by ``order``."""
    return _pick(df, keys, order, last=False)


def stack(*frames: DataFrame) -> DataFrame:
    """UNION ALL by column name; columns a frame lacks are NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def attach_daily(panel: DataFrame, daily: DataFrame, on: str, how: str = "left") -> DataFrame:
    """Join a table that has one row per calendar day.

    Only for tables grouped by a date: they are bounded by the calendar (36,525
    rows a century, 3.7 million for every date Spark can hold), so broadcasting
    is safe at any panel size and the panel is not shuffled by day, where one
    hot day would hold up a task.
    """
    return panel.join(F.broadcast(daily), on, how)


#: Parts that ``top_rows`` deals a group to first.
SALTS = 64


def top_rows(
    df: DataFrame, group: str, order: Sequence[Column], n: int, salt: Column, salts: int = SALTS
) -> DataFrame:
    """The first ``n`` rows of each group, with their position ``rn``.

    A group is dealt to ``salts`` parts by a hash of ``salt``. Rounds of merging
    keep the first ``n`` rows of each part and bring eight parts together, so that
    no task sees more than eight times ``n`` rows after the first round,
    whatever ``n`` is and however many rows one group has.
    """
    out = df.withColumn("_part", F.pmod(F.xxhash64(salt), F.lit(salts)))
    while True:
        by = Window.partitionBy(group, "_part") if salts > 1 else Window.partitionBy(group)
        out = out.withColumn("rn", F.row_number().over(by.orderBy(*order))).filter(F.col("rn") <= n)
        if salts == 1:
            return out.drop("_part")
        salts = -(-salts // 8)
        out = out.withColumn("_part", F.pmod(F.col("_part"), F.lit(salts)))


#: Parts that the values of a group are ranked in.
BUCKETS = 32


def spread_ranks(cells: DataFrame, group: str, value: str, weight: str, buckets: int = BUCKETS) -> DataFrame:
    """Rank of each distinct value in its group, ties averaged: (group, value, rank, group_size).

    ``weight`` says how many rows a cell stands for, so ties are counted, not
    repeated. Every group's values are cut at its own approximate quantiles, found
    by an aggregate that combines map-side, so a (group, bucket) holds about
    1/buckets of the group's distinct values and no task sorts a whole group.
    Ranks inside a bucket are offset by the sizes of the buckets below it, so
    where the cuts fall changes nothing but balance.
    """
    values = cells.groupBy(group, value).agg(F.sum(weight).alias("_ties"))
    steps = F.array(*[F.lit(i / max(2, buckets)) for i in range(1, max(2, buckets))])
    cuts = values.groupBy(group).agg(F.array_distinct(F.percentile_approx(value, steps, 4 * buckets)).alias("_cuts"))
    # Cuts ascend, so the bucket is the number of cuts below the value.
    placed = values.join(cuts, group).withColumn(
        "_bucket", F.aggregate("_cuts", F.lit(0), lambda n, c: n + F.when(c < F.col(value), 1).otherwise(0))
    ).drop("_cuts")
    below = Window.partitionBy(group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy(group, "_bucket")
        .agg(F.sum("_ties").alias("_size"))
        .select(
            group,
            "_bucket",
            F.coalesce(F.sum("_size").over(below), F.lit(0)).alias("_below"),
            F.sum("_size").over(Window.partitionBy(group)).alias("group_size"),
        )
    )
    inside = Window.partitionBy(group, "_bucket").orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    ranked = placed.withColumn("_upto", F.sum("_ties").over(inside)).join(offsets, [group, "_bucket"])
    rank = F.col("_below") + F.col("_upto") - (F.col("_ties") - 1) / 2.0
    return ranked.select(group, value, rank.alias("rank"), "group_size")


#: Rows of a group that one window ranks; a greater group is cut into ranges of about as many, into CUTS at most.
RANGE_ROWS = 50_000
CUTS = 1_000


def with_ranks(rows: DataFrame, group: str, values: Sequence[str], range_rows: int = RANGE_ROWS) -> DataFrame:
    """``rows`` with ``{value}_rank``, ties averaged, for each of ``values``, and ``group_size``; no group or value is NULL.

    One exchange for each value and no join back. A group of more than ``range_rows`` rows is cut at its own approximate
    quantiles, into ranges between cuts and the cuts themselves. A range is ranked by a window of its own; a cut is one value,
    so its rank follows from the counts alone, and its rows, however many tie
    there, may be dealt anywhere. Where the cuts fall changes nothing but balance. Tables of groups, cuts and counts
    are stored, so that Spark knows their size when it chooses a join. ``rows`` is read several times: it has to be stored first.
    """
    sizes = stored(rows.groupBy(group).agg(F.count(F.lit(1)).alias("group_size")), "sizes")
    steps = F.array(*[F.lit(i / CUTS) for i in range(1, CUTS)])
    great = sizes.where(F.col("group_size") > range_rows)
    quantiles = rows.join(great, group).groupBy(group).agg(F.first("group_size").alias("group_size"), *[F.percentile_approx(v, steps, 4 * CUTS).alias(v) for v in values])
    # Every so manyth quantile, as a range shall hold about ``range_rows``.
    stride = F.greatest(F.lit(1), F.floor(F.lit(float(CUTS) * range_rows) / F.col("group_size")))
    thinned = [F.array_sort(F.array_distinct(F.filter(v, lambda c, i: i % stride == 0))).alias(f"_cuts_{v}") for v in values]
    cuts = stored(quantiles.select(group, *thinned), "cuts")

    def place(v: str) -> Column:
        # Even places lie between cuts, odd ones are a cut: twice the cuts below the value, and one for a cut.
        below = F.aggregate(f"_cuts_{v}", F.lit(0), lambda k, c: k + F.when(c < F.col(v), 2).when(c == F.col(v), 1).otherwise(0))
        return F.coalesce(below, F.lit(0)).alias(f"_place_{v}")

    cut = rows.join(cuts, group).select(group, *map(place, values))
    sides = F.explode(F.array(*[F.struct(F.lit(i).alias("side"), F.col(f"_place_{v}").alias("place")) for i, v in enumerate(values)])).alias("_at")
    counts = cut.select(group, sides).groupBy(group, "_at").agg(F.count(F.lit(1)).alias("size")).select(group, "_at.*", "size")
    below = Window.partitionBy(group, "side").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    counts = stored(counts.withColumn("below", F.coalesce(F.sum("size").over(below), F.lit(0))), "counts")
    # Numbered as the stored rows are read: a task that runs again deals them as before.
    out = rows.withColumn("_number", F.monotonically_increasing_id()).join(sizes, group).join(cuts, group, "left")
    out = out.select(*rows.columns, "group_size", "_number", *map(place, values))
    for i, v in enumerate(values):
        at = f"_place_{v}"
        own = counts.where(F.col("side") == i).select(group, F.col("place").alias(at), "size", "below")
        is_cut = F.col(at) % 2 == 1
        out = out.withColumn("_deal", F.when(is_cut, F.pmod("_number", F.lit(CUTS))).otherwise(F.lit(0)))
        inside = Window.partitionBy(group, at, "_deal")
        ties = F.count(F.lit(1)).over(Window.partitionBy(group, at, "_deal", v))
        out = out.withColumns({"_before": F.rank().over(inside.orderBy(v)), "_ties": ties}).join(own, [group, at], "left")
        ranged = F.coalesce("below", F.lit(0)) + F.col("_before") + (F.col("_ties") - 1) / 2.0
        rank = F.when(is_cut, F.col("below") + (F.col("size") + 1) / 2.0).otherwise(ranged)
        out = out.withColumn(f"{v}_rank", rank).drop("_deal", "_before", "_ties", "size", "below", at)
    return out.drop("_number")
