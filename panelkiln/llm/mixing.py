"""Mixing sources to target weights by Efraimidis-Spirakis sampling, with DataFrame functions alone.

Each document gets the key -ln(u) / weight, u being a hash of the document: a
weighted draw without replacement takes a source's documents in the order of
their keys. A source first gets as many complete epochs as its budget of words
holds; the rest is taken from the front of that order, by prefix sums.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from panelkiln.llm.common import WORD, text_key
from panelkiln.session import stored

#: Weights of the sources in the order of their names, over and over.
CYCLE = (1.0, 2.0, 3.0)
MAX_EPOCHS = 3

#: Steps that the order of a source is cut into, so that no task has to order a whole source.
STEPS = 4096


def uniform(seed: int, *parts: Column) -> Column:
    """In (0, 1), the same on every run: 52 bits of an MD5."""
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sources: DataFrame, cycle: tuple[float, ...] = CYCLE, most: int = MAX_EPOCHS) -> DataFrame:
    """Adds ``target`` to (source, source_size), a table of one row per source.

    Weights follow the cycle in the order of the sources' code points, null
    last. All sizes together are shared by weight; no source gets more than
    ``most`` times its own size, and what is cut off is shared again by weight
    among the others. That ends where every source has the lesser of its limit
    and its weight times one common level, which the running sums over the
    sources by limit per weight give at once.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    place = F.row_number().over(order) - 1
    weighted = sources.select(
        "source",
        "source_size",
        F.element_at(F.array(*map(F.lit, cycle)), (place % len(cycle) + 1).cast("int")).alias("w"),
        (F.col("source_size") * float(most)).alias("limit"),
    )
    by_ratio = Window.orderBy(F.col("limit") / F.col("w"), F.col("source").asc_nulls_last())
    everything = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = F.coalesce(F.sum("limit").over(by_ratio.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    rest = F.sum("w").over(by_ratio.rowsBetween(0, Window.unboundedFollowing))
    level = weighted.withColumn("level", (F.sum("source_size").over(everything) - before) / rest)
    level = level.withColumn("level", F.max(F.when(F.col("level") * F.col("w") <= F.col("limit"), F.col("level"))).over(everything))
    share = F.coalesce(F.col("level") * F.col("w"), F.col("limit"))
    return level.select("source", "source_size", F.least("limit", share).alias("target"))


def mix(
    docs: DataFrame,
    weights: DataFrame | None = None,
    seed: int = 7,
    cycle: tuple[float, ...] = CYCLE,
    most: int = MAX_EPOCHS,
) -> DataFrame:
    """What the mix takes of each row of ``docs`` (doc_id, text, source).

    Returns doc_id, text_key, source, size, source_size, target, epochs, taken.
    ``taken`` counts words, repeats included: complete epochs of the document,
    then all, some (at the budget's end) or none of its words once more.

    ``weights`` (doc_id, weight) are quality weights over zero, one row per
    document; others, and documents without, count as 1. Rows without an id
    are taken by their text's hash. Equal rows are equal in the draw and counted
    each for itself. Null text has size 0 and is taken 0 times; null source is
    a source of its own, the last. Clashing extra columns play no part. An
    empty table gives an empty table.
    """
    sized = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        text_key(F.col("text")).alias("text_key"),
        F.col("source").alias("source"),
        words(F.col("text")).alias("size"),
        uniform(seed, F.col("doc_id"), F.md5(F.coalesce(F.col("text"), F.lit("")))).alias("u"),
    )
    if weights is None:
        sized = sized.withColumn("weight", F.lit(1.0))
    else:
        held = weights.select(F.col("doc_id").cast("long").alias("doc_id"), "weight").where("weight > 0")
        sized = sized.join(held, "doc_id", "left").withColumn("weight", F.coalesce("weight", F.lit(1.0)))
    key = -F.log("u") / F.col("weight")
    step = F.least(F.floor(F.lit(STEPS) * (1.0 - F.exp(-key))), F.lit(STEPS - 1)).cast("int")
    sized = stored(sized.select("doc_id", "text_key", "source", "size", key.alias("key"), step.alias("step")), "sized")

    steps = sized.groupBy("source", "step").agg(F.sum("size").alias("step_size"))
    earlier = Window.partitionBy("source").orderBy("step").rowsBetween(Window.unboundedPreceding, -1)
    steps = steps.withColumn("steps_before", F.coalesce(F.sum("step_size").over(earlier), F.lit(0)))
    goal = targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), cycle, most)
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    goal = goal.withColumn("epochs", epochs)
    budget = F.round("target").cast("long") - F.col("epochs") * F.col("source_size")
    goal = goal.withColumn("budget", budget)
    plan = steps.withColumnRenamed("source", "s").join(goal, F.col("s").eqNullSafe(F.col("source")))
    plan = plan.select(
        F.col("source").alias("s"), F.col("step").alias("t"), "source_size", "target", "epochs",
        (F.col("budget") - F.col("steps_before")).alias("room"),
    )
    drawn = sized.join(plan, F.col("source").eqNullSafe(F.col("s")) & (F.col("step") == F.col("t")))
    inside = Window.partitionBy("s", "t").orderBy("key", "doc_id", "text_key", "size")
    inside = inside.rowsBetween(Window.unboundedPreceding, -1)
    left = F.col("room") - F.coalesce(F.sum("size").over(inside), F.lit(0))
    once = F.greatest(F.lit(0).cast("long"), F.least(F.col("size"), left))
    return drawn.select(
        "doc_id", "text_key", "source", "size", "source_size", "target", "epochs",
        (F.col("epochs") * F.col("size") + once).alias("taken"),
    )


def mixed_documents(docs: DataFrame, weights: DataFrame | None = None, seed: int = 7, **rules) -> DataFrame:
    """The mix itself: rows of ``docs``, whole once per epoch, the part at a budget's end cut to its first words.

    Columns are those of ``docs``; ``n_chars`` of a cut row is counted anew.
    Words of a cut text are joined by one space. Rows without a word are left out.
    """
    taken = mix(docs, weights, seed, **rules).where("taken > 0").select("doc_id", "text_key", "source", "size", "taken")
    same = ["doc_id", "text_key", "source"]
    copies = Window.partitionBy(*[F.col(f"k_{c}") for c in same])
    taken = taken.select(*[F.col(c).alias(f"k_{c}") for c in same], "size", "taken")
    # Among equal rows the fuller ones are numbered first; equal rows that got nothing have no partner.
    taken = taken.withColumn("k_copy", F.row_number().over(copies.orderBy(F.desc("taken"))))
    taken = taken.select(*[F.col(f"k_{c}").alias(f"r_{c}") for c in same], F.col("k_copy").alias("r_copy"), "size", "taken")
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.col("doc_id").cast("long").alias("k_doc_id"),
        text_key(F.col("text")).alias("k_text_key"),
        F.col("source").alias("k_source"),
    )
    rows = rows.withColumn("k_copy", F.row_number().over(copies.orderBy(F.lit(0))))
    on = [F.col(f"k_{c}").eqNullSafe(F.col(f"r_{c}")) for c in [*same, "copy"]]
    joined = rows.join(taken, on)
    pieces = F.sequence(F.lit(1).cast("long"), F.ceil(F.col("taken") / F.col("size")).cast("long"))
    joined = joined.select("row", "size", "taken", F.explode(pieces).alias("copy"))
    cut = F.col("taken") - (F.col("copy") - 1) * F.col("size")
    whole = F.filter(F.split(F.col("row.text"), "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    front = F.array_join(F.slice(whole, 1, cut.cast("int")), " ")
    joined = joined.withColumn("cut_text", F.when(cut < F.col("size"), front))
    columns = [F.col(f"row.`{c}`").alias(c) for c in docs.columns]
    for i, name in enumerate(docs.columns):
        if name == "text":
            columns[i] = F.coalesce("cut_text", "row.text").alias("text")
        elif name == "n_chars":
            count = F.when(F.col("cut_text").isNotNull(), F.length("cut_text")).otherwise(F.col("row.n_chars"))
            columns[i] = count.cast(docs.schema[name].dataType).alias(name)
    return joined.select(*columns)


def label_weights(labels: DataFrame) -> DataFrame:
    """(doc_id, weight) from quality labels: good documents count double, bad ones half."""
    good = F.max("quality")
    return labels.where("quality is not null").groupBy("doc_id").agg(F.when(good == 1, 2.0).otherwise(0.5).alias("weight"))


#: DuckDB's way to the same rows, over whole sources.
SQL = """
WITH sized AS (
  SELECT d.doc_id, d.source, CASE WHEN d.text IS NULL THEN 0 ELSE len(regexp_extract_all(d.text, '[^\\x20\\x09-\\x0D]+')) END AS size,
         coalesce(q.weight, 1.0) AS weight, md5(coalesce(d.text, '')) AS m,
         (CAST('0x' || substr(md5('7|' || coalesce(CAST(d.doc_id AS VARCHAR), '') || '|' || md5(coalesce(d.text, ''))), 1, 13) AS BIGINT) + 0.5)
           / 4503599627370496.0 AS u
  FROM documents d LEFT JOIN (
    SELECT doc_id, CASE WHEN max(quality) = 1 THEN 2.0 ELSE 0.5 END AS weight FROM labels WHERE quality IS NOT NULL GROUP BY doc_id
  ) q USING (doc_id)),
sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         [1.0, 2.0, 3.0][(row_number() OVER (ORDER BY encode(source) ASC NULLS LAST) - 1) % 3 + 1] AS w, 3.0 * sum(size) AS lim
  FROM sized GROUP BY source),
levels AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(lim) OVER (ORDER BY lim / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(w) OVER (ORDER BY lim / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM sources),
goals AS (
  SELECT source, source_size,
         least(lim, coalesce((SELECT max(level) FROM levels WHERE level * w <= lim) * w, lim)) AS target
  FROM levels),
planned AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS epochs FROM goals),
ordered AS (
  SELECT s.*, p.source_size, p.target, p.epochs, CAST(round(p.target) AS BIGINT) - p.epochs * p.source_size
         - coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY -ln(u) / weight, s.doc_id, m ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS room
  FROM sized s JOIN planned p ON s.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, round(target, 3) AS target,
       CAST(epochs * size + greatest(0, least(size, room)) AS BIGINT) AS taken
FROM ordered
"""
