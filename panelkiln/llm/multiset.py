"""Document fingerprints by a homomorphic multiset hash of paragraphs.

Every paragraph is hashed to a wide vector; a document's fingerprint is the sum
of its paragraphs' vectors, lane by lane modulo 2**64. The order of paragraphs plays no
part, and inserting or deleting some adds or subtracts their vectors without
a look at the rest. The first ``UNIFORM`` lanes are uniform 64-bit numbers and tell equal
multisets from others, however often a paragraph repeats; in the ``SIGNS`` lanes after them a paragraph counts +1 or
-1, so that sums stay below the number of paragraphs (they are written modulo 2**32), and the cosine of two fingerprints' lanes estimates that of the
multisets' counts, with an error of about 1 / sqrt(SIGNS).
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from panelkiln.llm.common import keyed, shuffle_parts

UNIFORM = 12
SIGNS = 256
_BYTES = 8 * UNIFORM + SIGNS // 8

#: A paragraph ends with its line; within a line also after a sentence, so that long lines have parts.
_ENDS = re.compile(r"\n+|(?<=[.!?])[\x20\t]+")

#: Paragraphs hashed before their vectors are summed.
_BLOCK = 4096


def paragraphs(text: str | None) -> list[str]:
    """Stripped paragraphs in order, without empty ones."""
    return [p for piece in _ENDS.split(text or "") if (p := piece.strip())]


def vector(parts: list[str]) -> np.ndarray:
    """Sum of the paragraphs' vectors, as unsigned 64-bit lanes."""
    total = np.zeros(UNIFORM + SIGNS, np.uint64)
    for i in range(0, len(parts), _BLOCK):
        block = parts[i : i + _BLOCK]
        digest = b"".join(hashlib.shake_128(p.encode()).digest(_BYTES) for p in block)
        rows = np.frombuffer(digest, np.uint8).reshape(len(block), _BYTES)
        lanes = np.ascontiguousarray(rows[:, : 8 * UNIFORM]).view("<u8")
        ones = np.unpackbits(rows[:, 8 * UNIFORM :], axis=1).sum(axis=0, dtype=np.int64)
        total[:UNIFORM] += lanes.sum(axis=0, dtype=np.uint64)
        total[UNIFORM:] += (2 * ones - len(block)).view(np.uint64)
    return total


def edited(before: np.ndarray, deleted: list[str], inserted: list[str]) -> np.ndarray:
    """Fingerprint after an edit, from that before it and the changed paragraphs alone."""
    return before - vector(deleted) + vector(inserted)


def as_text(lanes: np.ndarray) -> str:
    return lanes[:UNIFORM].astype("<u8").tobytes().hex() + lanes[UNIFORM:].astype("<u4").tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """From 0 (nothing in common) to 1 (equal fingerprints)."""
    if np.array_equal(a, b):
        return 1.0
    x, y = (v[UNIFORM:].view(np.int64).astype(float) for v in (a, b))
    scale = float(np.sqrt((x @ x) * (y @ y)))
    return min(max(float(x @ y) / scale, 0.0), 1.0) if scale else 0.0


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fingerprint) of every row; a null text is empty, and an empty one has the zero fingerprint.

    Repeated rows give repeated rows, null ids stay null, other columns play no part.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = [as_text(vector(paragraphs(t))) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(marks, pa.string())], ["doc_id", "fingerprint"])

    return keyed(docs, id_col, text_col).mapInArrow(scan, "doc_id long, fingerprint string")


def with_next(docs: DataFrame) -> DataFrame:
    """(doc_id, text, fold, border) dealt into folds of neighbours by id, in order, null last.

    Folds start at ids that occur, found as approximate quantiles; a fold's
    first row is also sent to the fold before it (the first fold's to the last),
    with ``border`` true, so that every task can see what follows its last row.
    Only the folds' first ids, one per shuffle partition at most, reach the driver.
    Rows of one id, and rows without, stay in one fold: ids are meant to be unique.
    """
    parts = shuffle_parts(docs.sparkSession)
    steps = [i / parts for i in range(parts)]
    found = docs.agg(F.percentile_approx("doc_id", F.array(*map(F.lit, steps)), 100 * parts), F.min("doc_id")).first()
    firsts = sorted({found[1], *found[0]}) if found[0] is not None else []
    if not firsts:
        one = docs.withColumns({"fold": F.lit(0), "border": F.lit(False)}).repartition(1, "fold")
        return one.sortWithinPartitions("text")
    starts = F.array(*[F.lit(x).cast("long") for x in firsts])
    fold = F.when(F.col("doc_id").isNull(), F.lit(len(firsts) - 1)).otherwise(
        F.size(F.filter(starts, lambda s: s <= F.col("doc_id"))) - 1
    )
    before = F.pmod(fold - 1, F.lit(len(firsts)))
    leads = F.coalesce(F.array_contains(starts, F.col("doc_id")), F.lit(False))
    dealt = docs.withColumn(
        "place",
        F.explode(
            F.when(leads, F.array(F.struct(fold.alias("fold"), F.lit(False).alias("border")), F.struct(before.alias("fold"), F.lit(True).alias("border"))))
            .otherwise(F.array(F.struct(fold.alias("fold"), F.lit(False).alias("border"))))
        ),
    ).select("doc_id", "text", "place.fold", "place.border")
    dealt = dealt.repartitionById(len(firsts), F.col("fold").cast("int"))
    return dealt.sortWithinPartitions("border", F.col("doc_id").asc_nulls_last(), "text")


def edit_study(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every text and of an edited one, and how alike they are.

    The edited text has the last quarter of the code points (rounded down)
    replaced by the first as many, or all, of the next document's, by ascending
    id; after the last comes the first. Its fingerprint is got from the text's by
    deleting and inserting what the edit changed.

    Returns doc_id, n_chars, edited_text, fingerprint, edited_fingerprint,
    near_edited, near_next. Rows of one id are ordered by their texts, null ids
    come last; a single row is its own next. A null text is empty. An
    empty table gives an empty table. Other columns play no part.
    """
    rows = with_next(keyed(docs, id_col, text_col).withColumn("text", F.coalesce("text", F.lit(""))))
    schema = "doc_id long, n_chars long, edited_text string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    names = [part.split()[0] for part in schema.split(", ")]

    def compare(row: tuple, following: tuple) -> tuple:
        (doc_id, text, mark, parts), (_, after, after_mark, _) = row, following
        quarter = len(text) // 4
        changed = text[: len(text) - quarter] + after[:quarter]
        new = paragraphs(changed)
        same = 0
        while same < min(len(new), len(parts)) and new[same] == parts[same]:
            same += 1
        new_mark = edited(mark, parts[same:], new[same:])
        return (doc_id, len(text), changed, as_text(mark), as_text(new_mark), likeness(mark, new_mark), likeness(mark, after_mark))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Own rows come first, in order, then the row that follows them; of tied ones the first."""
        last, over, first = None, False, None
        types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
        out: list[tuple] = []

        def batch_of() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)

        for batch in batches:
            for i in range(batch.num_rows):
                if over:
                    break
                text = batch.column("text")[i].as_py()
                parts = paragraphs(text)
                row = (batch.column("doc_id")[i].as_py(), text, vector(parts), parts)
                first = first or row
                over = batch.column("border")[i].as_py()
                if last is not None:
                    out.append(compare(last, row))
                last = None if over else row
                if len(out) >= 500:
                    yield batch_of()
                    out = []
        if last is not None:  # no row has an id: they are one fold, which ends where it starts
            out.append(compare(last, first))
        if out:
            yield batch_of()

    return rows.mapInArrow(scan, schema)
