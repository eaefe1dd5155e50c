"""License notices in texts: MinHash bands over overlapping windows, then exact containment. DataFrame functions only.

A template of s shingles is looked for in windows of s + ceil(s / 2) shingles that
start every ceil(s / 2), so that every place it can be at lies whole in one of them. A window
that contains ``CONTAINMENT`` of the template has a Jaccard similarity of 0.8 / 1.7 or
more with it (0.47; a third if s is 1 or 2), and with one minimum a band the chance that none of
``BANDS`` bands meets is under 0.53**24 or (2/3)**24, that is one in 16,000. A window can only meet a
template where it holds one of the template's minima, so windows without any are passed over
before their own minima are taken; this loses no candidate.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from panelkiln.llm.common import keyed, text_key

SHINGLE = 5
CONTAINMENT = 0.8
BANDS = 24

#: Template minima, or shingles, beyond which the join with them is left to shuffle.
BROADCAST = 100_000

#: Notices as their licenses word them.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "Apache-2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. '
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    ),
    (
        "BSD",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    ),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    (
        "GPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published "
        "by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ),
    ("MIT", "Released under the MIT License."),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
        '(the "Software"), to deal in the Software without restriction',
    ),
)


def template_frame(spark: SparkSession, templates=TEMPLATES) -> DataFrame:
    return spark.createDataFrame(list(templates), "license string, text string")


def _words(text: Column) -> Column:
    """Runs of letters and digits in lower case."""
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def _shingles(words: Column, of) -> Column:
    """``of`` each run of ``SHINGLE`` words; of all words where there are fewer; none without a word."""
    n = F.size(words)
    starts = F.when(n > 0, F.sequence(F.lit(1), F.greatest(F.lit(1), n - SHINGLE + 1))).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: of(F.slice(words, i, SHINGLE)))


def _text(words: Column) -> Column:
    return F.array_join(words, " ")


def _minima(marks: Column) -> Column:
    return F.transform(
        F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda j: F.struct(j.alias("band"), F.array_min(F.transform(marks, lambda x: F.xxhash64(x, j))).alias("least"))
    )


def scan(docs: DataFrame, templates: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document and license found: doc_id, text_key, license, containment, first_shingle, n_windows.

    ``templates`` has license and text; a license may have several. They are a
    parameter, not a corpus: their minima, ``BANDS`` for each, are read by the driver, and up to
    ``BROADCAST`` of them are sent to all tasks. Words are
    runs of letters and digits in any case; shingles are ``SHINGLE`` words, so a template of fewer
    words is only found in a text that has no others. ``containment`` is the
    largest share of a template's distinct shingles in a window, ``CONTAINMENT`` or more;
    ``first_shingle`` is where the first such window starts (from 0). Texts that are null or have no words
    have no license; null ids stay null; equal rows are found once; other columns
    play no part. Empty tables give an empty table.
    """
    spark = docs.sparkSession
    templates = template_frame(spark) if templates is None else templates
    held = templates.select("license", F.array_distinct(_shingles(_words(F.col("text")), _text)).alias("shingles"))
    held = held.where(F.size("shingles") > 0).select(
        "license",
        "shingles",
        F.size("shingles").alias("size"),
        _minima(F.transform("shingles", lambda s: F.xxhash64(s))).alias("minima"),
        F.transform("shingles", lambda s: F.xxhash64(s)).alias("marks"),
    )
    rare = F.transform("minima", lambda m: F.filter("marks", lambda x: F.xxhash64(x, m.band) == m.least)[0])
    known = held.select("size", rare.alias("rare")).collect()
    small = len(known) * BANDS <= BROADCAST and sum(r["size"] for r in known) <= BROADCAST
    sizes = sorted({r["size"] for r in known})
    minima = sorted({m for r in known for m in r["rare"]})
    if not sizes:
        return spark.createDataFrame([], _RESULT)
    step = {s: math.ceil(s / 2) for s in sizes}
    classes = F.array(*[F.struct(F.lit(s).alias("size"), F.lit(step[s]).alias("step"), F.lit(s + step[s]).alias("width")) for s in sizes])

    # Each generated column is worked out once per document, whatever uses it.
    rows = keyed(docs, id_col, text_col).where("text is not null").withColumn("text_key", text_key(F.col("text")))
    rows = rows.select("doc_id", "text_key", F.explode(F.array(_words(F.col("text")))).alias("words"))
    hashed = _shingles(F.col("words"), lambda s: F.xxhash64(_text(s)))
    rows = rows.select("doc_id", "text_key", "words", F.explode(F.array(hashed)).alias("marks"))
    places = F.filter(F.transform("marks", lambda x, i: F.when(x.isin(minima), i)), lambda i: i.isNotNull())
    rows = rows.select("doc_id", "text_key", "words", "marks", F.explode(F.array(places)).alias("places")).where(F.size("places") > 0)

    def windows(p: Column, c: Column) -> Column:
        first = F.greatest(F.lit(0), F.ceil((p - c.width + 1) / c.step).cast("int"))
        return F.transform(F.sequence(first, F.floor(p / c.step).cast("int")), lambda k: F.struct(c.size.alias("size"), c.width.alias("width"), (k * c.step).alias("start")))

    every = F.flatten(F.transform("places", lambda p: F.flatten(F.transform(classes, lambda c: windows(p, c)))))
    rows = rows.select("doc_id", "text_key", "words", "marks", F.explode(F.array_distinct(every)).alias("w"))
    rows = rows.select(
        "doc_id", "text_key", "w.size", "w.start",
        F.slice("words", F.col("w.start") + 1, F.col("w.width") + SHINGLE - 1).alias("part"),
        F.slice("marks", F.col("w.start") + 1, F.col("w.width")).alias("marks"),
    )
    bands = rows.select("doc_id", "text_key", "size", "start", "part", F.explode(_minima(F.col("marks"))).alias("m"))
    bands = bands.select("doc_id", "text_key", "size", "start", "part", "m.band", "m.least")
    wanted = held.select("license", "shingles", "size", F.explode("minima").alias("m"))
    wanted = wanted.select("license", "shingles", "size", "m.band", "m.least")
    met = bands.join(F.broadcast(wanted) if small else wanted, ["size", "band", "least"])
    own = _shingles(F.col("part"), _text)
    share = F.size(F.array_intersect(own, F.col("shingles"))) / F.col("size")
    found = met.groupBy("doc_id", "text_key", "size", "start", "license", "shingles").agg(F.first("part").alias("part"))
    found = found.withColumn("share", share).where(F.col("share") >= CONTAINMENT)
    return found.groupBy("doc_id", "text_key", "license").agg(
        F.max("share").alias("containment"),
        F.min("start").cast("long").alias("first_shingle"),
        F.count_distinct("size", "start").alias("n_windows"),
    )


_RESULT = "doc_id long, text_key long, license string, containment double, first_shingle long, n_windows long"


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


#: DuckDB's way to the same rows: containment in every window, without MinHash.
SQL = f"""
WITH t AS (
  SELECT row_number() OVER () AS t, license, [w FOR w IN regexp_split_to_array(lower(text), '[^\\p{{L}}\\p{{N}}]+') IF w <> ''] AS w
  FROM (VALUES {", ".join(f"({_quoted(n)}, {_quoted(x)})" for n, x in TEMPLATES)}) AS v(license, text)),
ts AS (SELECT t, license, list_distinct([array_to_string(w[i:i+{SHINGLE - 1}], ' ') FOR i IN range(1, greatest(1, len(w) - {SHINGLE - 1}) + 1)]) AS s FROM t),
tt AS (SELECT t, license, len(s) AS size, unnest(s) AS s FROM ts),
d AS (SELECT doc_id, md5(text) AS m, [w FOR w IN regexp_split_to_array(lower(text), '[^\\p{{L}}\\p{{N}}]+') IF w <> ''] AS w FROM documents WHERE text IS NOT NULL),
ds AS (
  SELECT doc_id, m, unnest([struct_pack(i := i - 1, s := array_to_string(w[i:i+{SHINGLE - 1}], ' ')) FOR i IN range(1, greatest(1, len(w) - {SHINGLE - 1}) + 1)]) AS x
  FROM d WHERE len(w) > 0),
hits AS (
  SELECT doc_id, m, t, license, size, x.s AS s, x.i AS i, CAST(ceil(size / 2.0) AS BIGINT) AS step FROM ds JOIN tt ON x.s = tt.s),
placed AS (
  SELECT *, unnest(range(greatest(0, CAST(ceil((i - size - step + 1) / CAST(step AS DOUBLE)) AS BIGINT)), i // step + 1)) * step AS start FROM hits),
shares AS (
  SELECT doc_id, m, license, t, size, start, count(DISTINCT s) / CAST(size AS DOUBLE) AS share FROM placed
  GROUP BY doc_id, m, license, t, size, start HAVING count(DISTINCT s) / CAST(size AS DOUBLE) >= {CONTAINMENT})
SELECT doc_id, license, max(share) AS containment, CAST(min(start) AS BIGINT) AS first_shingle, count(DISTINCT (size, start)) AS n_windows
FROM shares GROUP BY doc_id, m, license
"""
