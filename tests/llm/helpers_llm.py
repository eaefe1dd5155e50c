"""Awkward documents, and frames with columns that clash with names used inside."""

import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, source string, lang string, n_chars long"
CLASHING = ("part", "key", "size", "row", "fingerprint", "words", "host", "spans")


def words(text):
    return WORD.findall(text or "")


def awkward(seed=0, n=60, vocabulary="ab cd ef gh éß Ω x. y, 7".split(), most=40):
    """Rows with nulls anywhere, empty texts, ties, copies, repeated rows and one very long text."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        text = "".join(rng.choice(vocabulary) + rng.choice([" ", " ", "  ", "\n", "\t"]) for _ in range(rng.randint(0, most)))
        rows.append([i if rng.random() > 0.1 else None, text, rng.choice(["b", "a", "é", None]), rng.choice(["en", None])])
    for k in range(0, n, 7):
        rows[k][1] = rows[(3 * k) % n][1]
    rows[1][1], rows[2][1], rows[3][1], rows[4][1] = None, "", " \n\t ", "one"
    rows[5][1] = " ".join(rng.choice(vocabulary) for _ in range(30_000))
    rows[6][0] = rows[7][0] = 7
    rows += [list(rows[8]), list(rows[8]), list(rows[9])]
    return [(*r, None if r[1] is None else len(r[1])) for r in rows]


def frame(spark, rows, clash=False):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    if clash:
        from pyspark.sql import functions as F

        df = df.withColumns({c: F.lit("other") for c in CLASHING})
    return df


def sorted_rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def by_repr(rows):
    return sorted(rows, key=repr)
