"""Near-duplicate documents by SimHash, candidates by pigeonring chains.

Fingerprints of 64 bits link at ``MAX_BITS`` differing bits or fewer. Cut the
bits into a ring of ``SEGMENTS`` segments: if two fingerprints differ in at most
t bits, then from some segment on, every chain of l consecutive segments differs
in at most floor(t * l / SEGMENTS) bits. For t = 2 and five segments those
budgets are 0, 0, 1, 1, 2: two equal segments in a row, and a third that
differs in one bit at most, so that one half of it is equal too. These 32
or so equal bits are the join key (ten keys a fingerprint); candidates that meet
there have to pass the budgets of the longer chains before the Hamming
distance of all bits is taken.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from panelkiln.llm.common import keyed, text_key, utf8
from panelkiln.llm.components import components
from panelkiln.session import stored

MAX_BITS = 2
SEGMENTS = 5
SEED = 42

#: (lowest bit, width) of each segment.
_RING = [(13 * i, 13 if i < SEGMENTS - 1 else 12) for i in range(SEGMENTS)]

#: Shingles whose bits are spread out at once.
_BLOCK = 1 << 16


def fingerprint(text: bytes | None, n: int = 3) -> int:
    """SimHash of the n-word shingles, repeats included; as a signed long."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = min(n, len(words))
    spans = zip(starts[: len(words) - n + 1].tolist(), ends[n - 1 :].tolist())
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(line[s:e], SEED) for s, e in spans), np.uint64, len(words) - n + 1)
    ones = np.zeros(64, np.int64)
    for i in range(0, len(hashes), _BLOCK):
        block = hashes[i : i + _BLOCK].astype("<u8", copy=False).view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > len(hashes), bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """(doc_id, text_key, fingerprint) of every row; the fingerprint is a long."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = [fingerprint(t, shingle) for t in utf8(batch.column("text"))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_key"), pa.array(marks, pa.int64())],
                ["doc_id", "text_key", "fingerprint"],
            )

    rows = keyed(docs, id_col, text_col).withColumn("text_key", text_key(F.col("text")))
    return rows.mapInArrow(scan, "doc_id long, text_key long, fingerprint long")


def _bits(x: Column, low: int, width: int) -> Column:
    return F.shiftrightunsigned(x, low).bitwiseAND(F.lit((1 << width) - 1))


def _chain_keys(x: Column) -> list[Column]:
    """Two keys for every place where a chain can start."""
    keys = []
    for i in range(SEGMENTS):
        first, second = (_bits(x, *_RING[(i + k) % SEGMENTS]) for k in (0, 1))
        low, width = _RING[(i + 2) % SEGMENTS]
        half = width // 2
        for j, third in enumerate((_bits(x, low, half), _bits(x, low + half, width - half))):
            tag = F.lit(2 * i + j).cast("long")
            key = F.shiftleft(F.shiftleft(F.shiftleft(tag, 13).bitwiseOR(first), 13).bitwiseOR(second), 7)
            keys.append(key.bitwiseOR(third))
    return keys


def _chain_holds(key: Column, difference: Column) -> Column:
    """The prefix sums of the chain that the key stands for keep within their budgets."""
    start = F.shiftrightunsigned(key, 34)  # below it: 13 + 13 + 7 bits and the half
    holds = None
    for i in range(SEGMENTS):
        total, within = F.lit(0), F.lit(True)
        for length in range(1, SEGMENTS + 1):
            low, width = _RING[(i + length - 1) % SEGMENTS]
            total = total + F.bit_count(_bits(difference, low, width))
            within = within & (total <= MAX_BITS * length // SEGMENTS)
        holds = F.when(start == i, within) if holds is None else holds.when(start == i, within)
    return holds


def links(marks: DataFrame, bucket_limit: int = 16) -> DataFrame:
    """Links (a, b) that connect whatever distinct ``fingerprint`` values reach each other.

    Buckets of up to ``bucket_limit`` fingerprints are joined with themselves.
    Those in a fuller bucket (a large group of near copies) are linked without
    pairs: two values within two bits share a value within one bit of both, so
    each sends itself and its 64 one-bit neighbours, and all that meet are
    linked to the least of them. Both ways are exact; the limit only says which
    one is cheaper.
    """
    x = F.col("fingerprint")
    keys = marks.select(x.alias("x"), F.explode(F.array(*_chain_keys(x))).alias("key"))
    sizes = keys.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = stored(keys.join(sizes, "key"), "buckets")
    small = shared.where(F.col("n") <= bucket_limit).drop("n")
    left, right = small.withColumnRenamed("x", "a"), small.withColumnRenamed("x", "b")
    difference = F.col("a").bitwiseXOR(F.col("b"))
    pairs = (
        left.join(right, "key")
        .where("a < b")
        .where(_chain_holds(F.col("key"), difference))
        .where(F.bit_count(difference) <= MAX_BITS)
        .select("a", "b")
    )
    full = shared.where(F.col("n") > bucket_limit).select("x").distinct()
    near = F.array(F.col("x"), *[F.col("x").bitwiseXOR(F.lit(1).cast("long") * _signed(1 << b)) for b in range(64)])
    balls = full.select("x", F.explode(near).alias("y"))
    least = balls.groupBy("y").agg(F.min("x").alias("a"), F.max("x").alias("z")).where("a < z").select("y", "a")
    met = balls.join(least, "y").where("x <> a").select("a", F.col("x").alias("b"))
    return pairs.union(met)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, bucket_limit: int = 16
) -> DataFrame:
    """One row per document: doc_id, text_key, fingerprint (16 hex digits), group, component_id.

    ``component_id`` is the smallest id among the documents that links reach,
    the document itself included; ``group`` is the same class as a number that
    never is null. Texts without a word (null, empty, white space) have
    fingerprint zero and link like any other. Copies and repeated rows share a
    fingerprint, which is matched once. A null id never is the smallest:
    the column is null only where a whole class has no id. Other columns of
    ``docs`` play no part. An empty table gives an empty table.
    """
    marked = stored(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    distinct = stored(marked.groupBy("fingerprint").agg(F.min("doc_id").alias("first_id")), "distinct")
    roots = components(links(distinct.select("fingerprint"), bucket_limit))
    placed = distinct.join(roots, distinct.fingerprint == roots.node, "left").select(
        "fingerprint", "first_id", F.coalesce("root", "fingerprint").alias("group")
    )
    placed = stored(placed, "groups")
    ids = placed.groupBy("group").agg(F.min("first_id").alias("component_id"))
    classes = placed.join(ids, "group").select("fingerprint", "group", "component_id")
    return marked.join(classes, "fingerprint").select(
        "doc_id", "text_key", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "group", "component_id"
    )
