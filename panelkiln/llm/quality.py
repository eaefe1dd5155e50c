"""Quality rules on a document's own words, and on lines that many documents of a host share.

Lines are normalised and hashed; of every host, the distinct documents that hold a line
are counted; lines above the host's limit are taken out, and a document of whose
words too few are left is rejected. Copies of one text are one document
in these counts, so that a much-copied text doesn't count against itself.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from panelkiln.llm.common import text_key, utf8
from panelkiln.session import stored

#: A line's limit is this share of the host's distinct documents, but no less than so many.
SHARE = 0.1
LEAST = 20

#: Below this share of its words a document is depleted.
LEFT = 0.5
MIN_WORDS = 50

_SPACE = b"\x20\x09\x0a\x0b\x0c\x0d"
_SYMBOLS = b"#*$%&|<>"
_OTHER = bytes(b for b in range(256) if b not in _SYMBOLS)
_TAILS = bytes(range(0x80, 0xC0)) + _SPACE
_DIGITS = re.compile(rb"[0-9]")


def line_hash(line: bytes) -> int | None:
    """Of the line in lower case (A-Z), digits as 0, white space as single spaces; None without a word. Signed."""
    words = line.lower().split()
    if not words:
        return None
    return xxhash.xxh64_intdigest(_DIGITS.sub(b"0", b" ".join(words))) - (1 << 63)


def measures(text: bytes) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    words = text.split()
    characters = len(text.translate(None, _TAILS))  # white space and the tails of long code points left out
    symbols = len(text.translate(None, _OTHER))
    lines = [line for line in text.split(b"\n") if line.strip(_SPACE)]
    repeated = 0
    windows = list(zip(words, words[1:], words[2:]))
    if len(set(windows)) < len(windows):
        counts, covered = Counter(windows), 0
        for i, window in enumerate(windows):
            if counts[window] > 1:
                repeated += i + 3 - max(i, covered)
                covered = i + 3
    return len(words), characters, symbols, len(lines) - len(set(lines)), repeated


def _measured(docs: DataFrame) -> DataFrame:
    """A row per document with its measures and, per distinct line, hash and number of words."""
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("")).alias("host"),
        text_key(F.col("text")).alias("text_key"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    schema = (
        "doc_id long, host string, text_key long, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
        "n_repeat_words long, lines array<struct<h: long, n: long>>"
    )
    names = [part.split()[0] for part in schema.split(", ")][:9]
    pairs = pa.list_(pa.struct([("h", pa.int64()), ("n", pa.int64())]))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, lines = [], []
            for text in utf8(batch.column("text")):
                found.append(measures(text))
                own: dict[int, int] = {}
                for line in text.split(b"\n"):
                    if (h := line_hash(line)) is not None:
                        own[h] = own.get(h, 0) + len(line.split())
                lines.append([{"h": h, "n": n} for h, n in own.items()])
            columns = zip(*found) if found else [()] * 5
            arrays = [batch.column(i) for i in range(3)] + [pa.array(c, pa.int64()) for c in columns] + [pa.array(lines, pairs)]
            yield pa.RecordBatch.from_arrays(arrays, names)

    return rows.mapInArrow(scan, schema)


def judged(docs: DataFrame, share: float = SHARE, least: int = LEAST, left: float = LEFT) -> DataFrame:
    """One row per document (doc_id, source, text): its measures, ``base_failed``, ``n_line_words``, ``kept``.

    Also host, text_key and ``frequent``, the hashes of the lines taken out. A line goes if over
    max(``least``, ``share`` of the host's distinct texts) distinct texts of the host hold
    it; ``n_line_words`` are the words on such lines. A document fails the base
    rules with under 50 words, or with over half of its words in repeated
    3-word windows, and is depleted if under ``left`` of its words are left.

    A null text has no words and fails; a null source is a host of its own;
    null ids stay null. Repeated rows and copies in one host share a verdict.
    Other columns play no part; an empty table gives an empty table.
    """
    measured = stored(_measured(docs), "measured")
    distinct = measured.groupBy("host", "text_key").agg(F.first("lines").alias("lines"))
    lines = distinct.select("host", "text_key", F.explode("lines").alias("line")).select("host", "text_key", "line.h", "line.n")
    counts = lines.groupBy("host", "h").agg(F.count(F.lit(1)).alias("held")).where(F.col("held") > least)
    hosts = distinct.groupBy("host").agg(F.count(F.lit(1)).alias("texts"))
    # At most the mean number of lines divided by the share, for each host.
    frequent = counts.join(hosts, "host").where(F.col("held") > F.col("texts") * share).select("host", "h")
    frequent = stored(frequent, "frequent")
    taken = lines.join(frequent, ["host", "h"]).groupBy("host", "text_key")
    taken = taken.agg(F.sum("n").alias("n_line_words"), F.collect_list("h").alias("frequent"))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    rows = measured.drop("lines").join(taken, ["host", "text_key"], "left")
    rows = rows.withColumns(
        {"n_line_words": F.coalesce("n_line_words", F.lit(0).cast("long")), "frequent": F.coalesce("frequent", F.array().cast("array<bigint>")), "base_failed": failed}
    )
    enough = F.col("n_words") - F.col("n_line_words") >= left * F.col("n_words")
    return rows.withColumn("kept", ~F.col("base_failed") & enough)


def without_lines(text: str | None, hashes: set[int]) -> str | None:
    if text is None or not hashes:
        return text
    return "\n".join(line for line in text.split("\n") if line_hash(line.encode()) not in hashes)


def filtered(docs: DataFrame, **limits) -> DataFrame:
    """The documents that are kept, in the columns of ``docs``, their frequent lines taken out.

    ``n_chars``, if there, is counted anew where a text changed.
    """
    kept = judged(docs, **limits).where("kept").select("host", "text_key", "frequent").distinct()
    names = docs.columns
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"),
        F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("")).alias("host"),
        text_key(F.col("text")).alias("text_key"),
    )
    rows = rows.join(kept, ["host", "text_key"]).select("row.*", F.col("frequent").alias("lines taken out"))
    at = names.index("text")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            arrays, frequent = list(batch.columns[:-1]), batch.column(len(names)).to_pylist()
            if any(frequent):
                before = arrays[at].to_pylist()
                after = [without_lines(t, set(f)) for t, f in zip(before, frequent)]
                arrays[at] = pa.array(after, batch.schema.field(at).type)
                if "n_chars" in names:
                    k = names.index("n_chars")
                    counts = [len(b) if a != b else n for a, b, n in zip(before, after, arrays[k].to_pylist())]
                    arrays[k] = pa.array(counts, batch.schema.field(k).type)
            yield pa.RecordBatch.from_arrays(arrays, names)

    return rows.mapInArrow(scan, docs.schema)


_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"
_LOWER = "abcdefghijklmnopqrstuvwxyz0000000000"

#: DuckDB's way to the rows of the query, on lines and words themselves.
SQL = f"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS t, coalesce('t' || text, 'n') AS k,
         [x FOR x IN regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+') IF x <> ''] AS w FROM documents),
windows AS (
  SELECT r, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS s FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM d WHERE len(w) > 2)),
covered AS (
  SELECT r, count(DISTINCT j) AS n FROM (
    SELECT r, unnest(range(i, i + 3)) AS j FROM (SELECT r, i, count(*) OVER (PARTITION BY r, s) AS c FROM windows) WHERE c > 1) GROUP BY r),
lines AS (
  SELECT r, source, k, line,
         trim(regexp_replace(translate(line, '{_UPPER}', '{_LOWER}'), '[\\x20\\x09-\\x0D]+', ' ', 'g'), ' ') AS s,
         len([x FOR x IN regexp_split_to_array(line, '[\\x20\\x09-\\x0D]+') IF x <> '']) AS n
  FROM (SELECT r, source, k, unnest(string_split(t, chr(10))) AS line FROM d)),
dups AS (SELECT r, count(*) - count(DISTINCT line) AS n FROM lines WHERE n > 0 GROUP BY r),
hosts AS (SELECT source, count(DISTINCT k) AS texts FROM d GROUP BY source),
held AS (SELECT source, s, count(DISTINCT k) AS held FROM lines WHERE n > 0 GROUP BY source, s),
frequent AS (
  SELECT held.source, s FROM held JOIN hosts ON held.source IS NOT DISTINCT FROM hosts.source WHERE held > {LEAST} AND held > texts * CAST({SHARE} AS DOUBLE)),
taken AS (
  SELECT r, sum(n) AS n FROM lines JOIN frequent ON lines.source IS NOT DISTINCT FROM frequent.source AND lines.s = frequent.s GROUP BY r),
m AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(regexp_replace(t, '[\\x20\\x09-\\x0D]', '', 'g')) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, CAST(coalesce(dups.n, 0) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(covered.n, 0) AS BIGINT) AS n_repeat_words, CAST(coalesce(taken.n, 0) AS BIGINT) AS n_line_words
  FROM d LEFT JOIN dups USING (r) LEFT JOIN covered USING (r) LEFT JOIN taken USING (r)),
b AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, n_line_words,
       NOT base_failed AND n_words - n_line_words >= {LEFT} * n_words AS kept
FROM b
"""
