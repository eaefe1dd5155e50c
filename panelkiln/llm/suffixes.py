"""Long repeated byte strings, found with a logarithmic family of suffix arrays.

Of every string of ``length`` bytes, the least of its ``GRAM``-byte pieces (by a
hash) is its anchor: equal strings have equal anchors at equal places, and one
anchor serves a run of starts. Anchors are brought together first, and only suffixes
at anchors that occur again go on: a suffix travels once for its anchor's whole
run of starts, with its bytes.

The bytes come in batches. Each batch gets a suffix array: its starts in the order of
the strings at them. Only matches of ``length`` bytes count, so the order is that of
a fingerprint of the first ``length`` bytes. A new array is scanned against
the levels of the family for equal neighbours, what it adds becomes a level, and
levels of like size merge, so that there are never more than a logarithm of the batches.
Matches are verified on the bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from panelkiln.llm import packed
from panelkiln.llm.common import keyed, shuffle_parts, text_key, utf8

LENGTH = 200
GRAM = 64

#: Bytes of text that a task looks at together; longer texts are cut into overlapping segments.
GATHER = 2 << 20
_PLACE = 24  # bits for a place among them

#: Tasks that match suffixes, for each shuffle partition: they hold their suffixes' bytes and marks.
FINER = 4

_ANCHORS, _KNOWN, _SUFFIXES, _RUNS = range(4)

_TABLE = np.random.default_rng(200).integers(1 << 63, size=256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_BACK = pow(_BASE, -1, 1 << 64)
_powers: list[np.ndarray] = []


def _power_tables(n: int) -> list[np.ndarray]:
    if not _powers or len(_powers[0]) < n:
        size = max(n, GATHER + (GATHER >> 1))
        _powers[:] = []
        for base in (_BASE, _BACK):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers.append(np.cumprod(steps, dtype=np.uint64))
    return _powers


def rolling(data: np.ndarray, width: int) -> np.ndarray:
    """A 64-bit hash of the ``width`` bytes at every place that has so many."""
    n = len(data) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    up, down = _power_tables(len(data))
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_TABLE[data] * up[: len(data)], dtype=np.uint64, out=total[1:])
    out = total[width:] - total[:n]
    out *= down[:n]
    return packed.mixed(out)


def _least(keys: np.ndarray, width: int) -> np.ndarray:
    """Least of ``width`` keys from every place on."""
    n = len(keys) - width + 1
    padded = np.full(-(-len(keys) // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(keys)] = keys
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).reshape(-1)
    behind = np.ascontiguousarray(np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1]).reshape(-1)
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


class Segments:
    """Texts, or overlapping parts of long ones, laid end to end. Every start of a string is in one of them."""

    def __init__(self, length: int):
        self.length, self.keys, self.bases, self.texts, self.size = length, [], [], [], 0

    def add(self, key: tuple[int, int], text: bytes) -> Iterator[Segments]:
        """Take in a text; whenever ``GATHER`` bytes are held, they are handed out, also within it."""
        for base in range(0, max(1, len(text) - self.length + 1), GATHER):
            part = text[base : base + GATHER + self.length - 1]
            if len(part) >= self.length:
                self.keys.append(key)
                self.bases.append(base)
                self.texts.append(part)
                self.size += len(part)
                if self.size >= GATHER:
                    yield self
                    self.keys, self.bases, self.texts, self.size = [], [], [], 0

    def anchors(self) -> tuple[np.ndarray, ...]:
        """(data, segment, anchor, first start, number of starts, hash of the anchor); places in ``data``."""
        length, grams = self.length, self.length - GRAM + 1
        data = np.frombuffer(b"".join(self.texts), np.uint8)
        sizes = np.array([len(t) for t in self.texts])
        ends = np.cumsum(sizes)
        hashes = rolling(data, GRAM)
        if len(hashes) > 1 << _PLACE:
            raise ValueError(f"{len(hashes)} places don't fit in {_PLACE} bits")
        low = np.uint64((1 << _PLACE) - 1)
        keys = (hashes & ~low) | np.arange(len(hashes), dtype=np.uint64)
        best = (_least(keys, grams) & low).astype(np.int64)
        last = np.zeros(len(best), np.int8)
        # A start is good if its string ends in its own segment.
        edges = np.zeros(len(data) + 1, np.int8)
        edges[ends - sizes] += 1
        edges[ends - length + 1] -= 1
        last = np.cumsum(edges[: len(best)], dtype=np.int8)
        starts = np.flatnonzero(last)
        segment = np.repeat(np.arange(len(sizes)), sizes - length + 1)
        at = best[starts]
        new = np.ones(len(at), bool)
        new[1:] = (at[1:] != at[:-1]) | (segment[1:] != segment[:-1])
        first = np.flatnonzero(new)
        count = np.diff(first, append=len(at))
        return data, segment[first], at[first], starts[first], count, hashes[at[first]]


def _route(hashes: np.ndarray, parts: int) -> np.ndarray:
    """Part of each anchor. Anchors are least hashes, so their upper bits are small and have to be mixed again."""
    return packed.spread(packed.mixed(hashes * np.uint64(_BASE)), parts)


def _by_document(ids: np.ndarray, tags: np.ndarray, columns: list[np.ndarray], kind: int, parts: int) -> Iterator[tuple[int, int, bytes]]:
    order = np.lexsort((columns[0], tags, ids))
    ids, tags, columns = ids[order], tags[order], [c[order] for c in columns]
    for part, where in packed.dealt(packed.spread(packed.mixed(ids.astype(np.uint64)), parts)):
        yield part, kind, packed.pack(*(np.diff(c[where], prepend=c.dtype.type(0)) for c in (ids, tags, *columns)))


def _gathered(blobs: list[bytes], width: int) -> list[np.ndarray]:
    """Columns of ``_by_document`` rows, ordered by document and place."""
    columns = packed.joined([[np.cumsum(c, dtype=c.dtype) for c in packed.unpack(b)] for b in blobs], width)
    order = np.lexsort((columns[2], columns[1], columns[0]))
    return [c[order] for c in columns]


def _documents(ids: np.ndarray, tags: np.ndarray) -> list[tuple[int, int]]:
    new = np.ones(len(ids), bool)
    new[1:] = (ids[1:] != ids[:-1]) | (tags[1:] != tags[:-1])
    first = np.flatnonzero(new)
    return list(zip(first.tolist(), [*first[1:].tolist(), len(ids)]))


def _send_anchors(segments: Segments, parts: int) -> Iterator[tuple[int, int, bytes]]:
    """One anchor for all equal ones in sight; the others are known to be repeated."""
    if not segments.texts:
        return
    _, segment, at, _, _, hashes = segments.anchors()
    keys = np.array(segments.keys, np.int64)
    ids, tags = keys[segment, 0], keys[segment, 1].astype(np.int32)
    sizes = np.array([len(t) for t in segments.texts])
    at = at - (np.cumsum(sizes) - sizes)[segment] + np.array(segments.bases)[segment]
    order = np.argsort(hashes, kind="stable")
    new = np.ones(len(order), bool)
    new[1:] = hashes[order][1:] != hashes[order][:-1]
    first = np.flatnonzero(new)
    again = np.repeat(np.diff(first, append=len(order)) > 1, np.diff(first, append=len(order)))
    known = order[again]
    yield from _by_document(ids[known], tags[known], [at[known]], _KNOWN, parts)
    heads, known = order[first], again[first].astype(np.uint8)
    for part, where in packed.dealt(_route(hashes[heads], parts)):
        own = heads[where]
        by = np.argsort(own)
        own, flags = own[by], known[where][by]
        yield part, _ANCHORS, packed.pack(
            hashes[own], np.diff(ids[own], prepend=np.int64(0)), np.diff(tags[own], prepend=np.int32(0)), np.diff(at[own], prepend=np.int64(0)), flags
        )


def _meet_anchors(blobs: list[bytes], parts: int) -> Iterator[tuple[int, int, bytes]]:
    if not blobs:
        return
    tables = []
    for b in blobs:
        hashes, ids, tags, at, known = packed.unpack(b)
        tables.append([hashes, np.cumsum(ids), np.cumsum(tags, dtype=np.int32), np.cumsum(at), known])
    hashes, ids, tags, at, known = packed.joined(tables, 5)
    order = np.argsort(hashes, kind="stable")
    new = np.ones(len(order), bool)
    new[1:] = hashes[order][1:] != hashes[order][:-1]
    first = np.flatnonzero(new)
    again = np.repeat(np.diff(first, append=len(order)) > 1, np.diff(first, append=len(order)))
    found = order[again]
    found = found[known[found] == 0]
    yield from _by_document(ids[found], tags[found], [at[found]], _KNOWN, parts)


def _send_suffixes(segments: Segments, wanted: dict[tuple[int, int], np.ndarray], finer: int, parts: int) -> Iterator[tuple[int, int, bytes]]:
    """The bytes under the runs of starts whose anchors are repeated; one of all equal ones in sight."""
    if not segments.texts:
        return
    data, segment, at, start, count, hashes = segments.anchors()
    sizes = np.array([len(t) for t in segments.texts])
    shift = np.array(segments.bases) - (np.cumsum(sizes) - sizes)
    place = at + shift[segment]
    cuts = np.searchsorted(segment, np.arange(len(sizes) + 1))
    good = np.zeros(len(at), bool)
    for i, key in enumerate(segments.keys):
        own = slice(cuts[i], cuts[i + 1])
        good[own] = np.isin(place[own], wanted[key])
    chosen = np.flatnonzero(good)
    raw, keys, length = data.tobytes(), np.array(segments.keys, np.int64), segments.length
    seen: dict[tuple[int, bytes], int] = {}
    head, texts, lead, repeated = [], [], at - start, set()
    same = []
    for i in chosen.tolist():
        text = raw[start[i] : start[i] + count[i] + length - 1]
        j = seen.setdefault((int(lead[i]), text), i)
        if i == j:
            head.append(i)
            texts.append(text)
        else:
            same.append(i)
            repeated.add(j)
    if same:
        where = np.array([*same, *repeated])
        first = start[where] + shift[segment[where]]
        who = keys[segment[where]]
        yield from _by_document(who[:, 0], who[:, 1].astype(np.int32), [first, count[where]], _RUNS, parts)
    if not head:
        return
    head = np.array(head)
    settled = np.fromiter((i in repeated for i in head.tolist()), np.uint8, len(head))
    who, first = keys[segment[head]], start[head] + shift[segment[head]]
    for part, where in packed.dealt(_route(hashes[head], finer)):
        # Sorted, like bytes stand together and compress.
        own = sorted(where.tolist(), key=lambda j: texts[j][int(lead[head[j]]) :])
        body = np.frombuffer(b"".join(texts[j] for j in own), np.uint8)
        own = np.array(own)
        columns = (who[own, 0], who[own, 1].astype(np.int32), first[own], count[head[own]].astype(np.int32), settled[own])
        yield part, _SUFFIXES, packed.pack(*columns, body)


class Family:
    """Suffix arrays of doubling size. A level holds distinct strings' fingerprints, ascending, and a start of each."""

    def __init__(self) -> None:
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []

    def add(self, marks: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Take in a batch; pairs (start, other start) so that each start with a match, new or old, is in some pair."""
        order = np.argsort(marks, kind="stable")
        marks, starts = marks[order], starts[order]
        new = np.ones(len(marks), bool)
        new[1:] = marks[1:] != marks[:-1]
        first = np.flatnonzero(new)
        of = np.cumsum(new) - 1
        ones, others = [starts[~new]], [starts[first[of[~new]]]]
        marks, starts = marks[first], starts[first]
        for have, where in self.levels:
            at = np.minimum(np.searchsorted(have, marks), len(have) - 1)
            met = have[at] == marks
            ones.append(starts[met])
            others.append(where[at[met]])
            marks, starts = marks[~met], starts[~met]
        if len(marks):
            self.levels.append((marks, starts))
        while len(self.levels) > 1 and 2 * len(self.levels[-1][0]) >= len(self.levels[-2][0]):
            (a, x), (b, y) = self.levels.pop(), self.levels.pop()
            marks, starts = np.concatenate([b, a]), np.concatenate([y, x])
            order = np.argsort(marks, kind="stable")  # two ascending runs: merged in one pass
            self.levels.append((marks[order], starts[order]))
        return np.concatenate(ones), np.concatenate(others)


def _verified(data: np.ndarray, ones: np.ndarray, others: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs whose strings are equal byte by byte; pairs that go on together are compared at once."""
    order = np.argsort(ones, kind="stable")
    ones, others = ones[order], others[order]
    new = np.ones(len(ones), bool)
    new[1:] = (ones[1:] != ones[:-1] + 1) | (others[1:] != others[:-1] + 1)
    first = np.flatnonzero(new)
    good = np.ones(len(ones), bool)
    raw = data.tobytes()
    runs = zip(first.tolist(), np.diff(first, append=len(ones)).tolist(), ones[first].tolist(), others[first].tolist())
    for i, n, a, b in runs:
        if raw[a : a + n + length - 1] != raw[b : b + n + length - 1]:
            good[i : i + n] = [raw[a + k : a + k + length] == raw[b + k : b + k + length] for k in range(n)]
    return ones[good], others[good]


def _meet_suffixes(blobs: list[bytes], length: int, parts: int) -> Iterator[tuple[int, int, bytes]]:
    """Runs of starts whose strings occur again, from batches that come one after the other."""
    if not blobs:
        return
    family, tables, pairs, size = Family(), [], [], 0
    for blob in blobs:
        ids, tags, first, count, settled, body = packed.unpack(blob)
        widths = count.astype(np.int64) + length - 1
        begin = (np.cumsum(widths) - widths).astype(np.int32)
        at = np.arange(int(count.sum()), dtype=np.int32) + np.repeat(begin - (np.cumsum(count) - count).astype(np.int32), count)
        pairs.append(family.add(rolling(body, length)[at], at + np.int32(size)))
        tables.append([ids, tags, first, count, settled, body, begin + np.int32(size)])
        size += len(body)
    del family, at
    ids, tags, first, count, settled, body, begin = packed.joined(tables, 7)
    del tables
    ones, others = _verified(body, *(np.concatenate(x) for x in zip(*pairs)), length)
    hit = np.zeros(size, bool)
    hit[ones], hit[others] = True, True
    del pairs, ones, others, body
    inner = np.arange(int(count.sum()), dtype=np.int32) - np.repeat((np.cumsum(count) - count).astype(np.int32), count)
    owner = np.repeat(np.arange(len(count), dtype=np.int32), count)
    found = np.flatnonzero(hit[begin[owner] + inner] & (settled[owner] == 0))
    owner, inner = owner[found], inner[found]
    new = np.ones(len(owner), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (inner[1:] != inner[:-1] + 1)
    heads = np.flatnonzero(new)
    who = owner[heads]
    run = np.diff(heads, append=len(owner))
    yield from _by_document(ids[who], tags[who], [first[who] + inner[heads], run], _RUNS, parts)


_ASKED = "a_id long, a_tag int, data binary"


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """One row per document: doc_id, n_bytes, kept (binary) and ``spans``, the maximal removed runs of bytes (first, stop).

    A byte of the UTF-8 text goes if a string of ``length`` bytes over it also
    starts anywhere else, in the same text or another; strings are those of the
    input and never cross documents. A null text is empty. Repeated rows are documents like
    any other; a null id stays null and its text counts; other columns play no
    part. An empty table gives an empty table.
    """
    if length < 2 * GRAM:
        raise ValueError(f"length must be {2 * GRAM} or more")
    parts = shuffle_parts(docs.sparkSession)
    key = text_key(F.coalesce("text", F.lit("")))
    rows = keyed(docs, id_col, text_col).select(
        "doc_id",
        F.coalesce("doc_id", key).alias("k_id"),
        key.bitwiseAND(F.lit(0x7FFFFFFF)).cast("int").alias("k_tag"),
        "text",
    )

    def with_text(asked: DataFrame) -> DataFrame:
        """Both uses share one shuffle of the texts, as they are alike."""
        on = (rows.k_id == asked.a_id) & (rows.k_tag == asked.a_tag)
        return rows.join(asked, on, "left").select("doc_id", "k_id", "k_tag", "text", "data")

    def send_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found() -> Iterator[tuple[int, int, bytes]]:
            held = Segments(length)
            for batch in batches:
                for i, tag, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).cast(pa.binary())):
                    for full in held.add((i, tag), text.as_py() or b""):
                        yield from _send_anchors(full, parts)
            yield from _send_anchors(held, parts)

        return packed.rows(found())

    def meet(kind: int, answer):
        def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            def found() -> Iterator[tuple[int, int, bytes]]:
                here = []
                for batch in batches:
                    for part, own, data in zip(*(batch.column(i).to_pylist() for i in range(3))):
                        if own == kind:
                            here.append(data)
                        else:
                            yield part, own, data
                yield from answer(here)

            return packed.rows(found())

        return scan

    def per_document(width: int):
        def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            blobs = [data for batch in batches for data in batch.column(2).to_pylist()]
            if not blobs:
                return
            ids, tags, *columns = _gathered(blobs, width)
            cuts = _documents(ids, tags)
            for i in range(0, len(cuts), 5000):
                some = cuts[i : i + 5000]
                data = [packed.pack(*(c[a:b] for c in columns)) for a, b in some]
                at = [a for a, _ in some]
                yield pa.RecordBatch.from_arrays([pa.array(ids[at]), pa.array(tags[at]), pa.array(data, pa.binary())], ["a_id", "a_tag", "data"])

        return scan

    def send_suffixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found() -> Iterator[tuple[int, int, bytes]]:
            held, wanted = Segments(length), {}
            for batch in batches:
                columns = batch.column(1).to_pylist(), batch.column(2).to_pylist(), batch.column(3).cast(pa.binary()), batch.column(4).to_pylist()
                for i, tag, text, data in zip(*columns):
                    if data is None:
                        continue
                    wanted[i, tag] = packed.unpack(data)[0]
                    for full in held.add((i, tag), text.as_py() or b""):
                        yield from _send_suffixes(full, wanted, FINER * parts, parts)
                        wanted = {(i, tag): wanted[i, tag]}
            yield from _send_suffixes(held, wanted, FINER * parts, parts)

        return packed.rows(found())

    def dealt(frame: DataFrame, n: int = parts) -> DataFrame:
        return frame.repartitionById(n, F.col("part"))

    anchors = dealt(rows.select("k_id", "k_tag", "text").mapInArrow(send_anchors, packed.SCHEMA))
    known = dealt(anchors.mapInArrow(meet(_ANCHORS, lambda here: _meet_anchors(here, parts)), packed.SCHEMA))
    known = known.mapInArrow(per_document(3), _ASKED)
    suffixes = dealt(with_text(known).mapInArrow(send_suffixes, packed.SCHEMA), FINER * parts)
    runs = dealt(suffixes.mapInArrow(meet(_SUFFIXES, lambda here: _meet_suffixes(here, length, parts)), packed.SCHEMA))
    runs = runs.mapInArrow(per_document(4), _ASKED)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span = pa.list_(pa.struct([("first", pa.int64()), ("stop", pa.int64())]))
        for batch in batches:
            kept, spans, sizes = [], [], []
            for text, data in zip(utf8(batch.column(3)), batch.column(4).to_pylist()):
                text, own, left, at = text or b"", [], [], 0
                if data is not None:
                    first, run = packed.unpack(data)
                    stop = np.maximum.accumulate(first + run + length - 1)
                    new = np.ones(len(first), bool)
                    new[1:] = first[1:] > stop[:-1]
                    heads = np.flatnonzero(new)
                    own = list(zip(first[heads].tolist(), stop[np.append(heads[1:] - 1, len(first) - 1)].tolist()))
                for a, b in own:
                    left.append(text[at:a])
                    at = b
                left.append(text[at:])
                kept.append(b"".join(left))
                sizes.append(len(text))
                spans.append([{"first": a, "stop": b} for a, b in own])
            arrays = [batch.column(0), pa.array(sizes, pa.int64()), pa.array(kept, pa.binary()), pa.array(spans, span)]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "n_bytes", "kept", "spans"])

    return with_text(runs).mapInArrow(cut, "doc_id long, n_bytes long, kept binary, spans array<struct<first: long, stop: long>>")
