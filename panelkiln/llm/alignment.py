"""Alignment of two tokenizers' ids over the same bytes, as a monoid of fragments.

A fragment is what a byte range of a text yields: the ids of both tokenizers
whose bytes end in the range, and the cuts, where both have an id that ends. What stands before
the first cut is the open prefix, which an earlier fragment may still extend;
what stands between cuts are closed groups; what follows the last cut is the open suffix.
Fragments compose associatively: the suffix of one and the prefix of the next
become a closed group. So ranges of a very long text are aligned in many tasks
and put together by a tree of any shape.

Neither tokenizer joins what a space parts, if the space follows anything but a space and
precedes anything but white space. Texts are taken apart there; parts that come back are
looked up, as in most texts most are.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from panelkiln.llm import packed
from panelkiln.llm.common import keyed
from panelkiln.session import stored

#: Code points of a text that one task aligns; a longer one is dealt to several.
RANGE = 1 << 16

#: Code points of texts that are looked at together, and bytes of links that share one table of pairs.
TEXTS = 1 << 20
TOGETHER = 4 << 20

#: Fragments that are composed at once.
FAN_IN = 16

#: Parts that are encoded at once.
WORDS = 4_000

#: Code points of parts that a task remembers.
REMEMBERED = 2 << 20

_CUT = re.compile(r"(?<=[^ ]) (?=\S)")
_SPACE = "▁"

#: A table of what tasks found. kind 0: a pair of ids and how often the table's texts link it; kind 1: the texts.
_FOUND = "table string, kind int, number long, a long, b long, n long, data binary"


@dataclass
class Fragment:
    """Ids of both tokenizers, and how many of each precede every cut. ``good`` is False where the bytes differ."""

    a: np.ndarray
    b: np.ndarray
    a_cuts: np.ndarray
    b_cuts: np.ndarray
    good: bool = True

    @classmethod
    def none(cls) -> Fragment:
        return cls(*(np.zeros(0, np.int64) for _ in range(4)))

    @classmethod
    def of_range(cls, a: np.ndarray, a_ends: np.ndarray, b: np.ndarray, b_ends: np.ndarray, start: int, stop: int) -> Fragment:
        """What ends behind byte ``start`` and no later than ``stop``, by the byte offsets where ids end, ascending."""
        i, j = np.searchsorted(a_ends, [start, stop], "right")
        k, m = np.searchsorted(b_ends, [start, stop], "right")
        both = np.intersect1d(a_ends[i:j], b_ends[k:m], assume_unique=True)
        return cls(a[i:j], b[k:m], np.searchsorted(a_ends[i:j], both) + 1, np.searchsorted(b_ends[k:m], both) + 1)

    def __add__(self, other: Fragment) -> Fragment:
        return composed([self, other])

    @property
    def prefix(self) -> tuple[np.ndarray, np.ndarray]:
        """Ids up to the first cut; without a cut everything is suffix."""
        return (self.a[: self.a_cuts[0]], self.b[: self.b_cuts[0]]) if len(self.a_cuts) else (self.a[:0], self.b[:0])

    @property
    def suffix(self) -> tuple[np.ndarray, np.ndarray]:
        return (self.a[self.a_cuts[-1] :], self.b[self.b_cuts[-1] :]) if len(self.a_cuts) else (self.a, self.b)

    @property
    def closed(self) -> list[tuple[np.ndarray, np.ndarray]]:
        return list(zip(np.split(self.a, self.a_cuts)[1:-1], np.split(self.b, self.b_cuts)[1:-1]))

    def groups(self) -> list[str]:
        """Of a whole text, whose end is a cut: each group as ``a1,a2|b1``."""
        texts = (tuple(np.array([f"{i}{mark}" for i in ids.tolist()], object) for mark in (",", end)) for ids, end in ((self.a, "|"), (self.b, ";")))
        places = Fragment(np.arange(len(self.a)), np.arange(len(self.b)), self.a_cuts, self.b_cuts)
        return "".join(places.written(*texts)).split(";")[:-1]

    def written(self, a_text: tuple[np.ndarray, np.ndarray], b_text: tuple[np.ndarray, np.ndarray]) -> list[str]:
        """All groups of a whole text id by id, given how an id is written within and at the end of its side of a group."""
        sides = []
        for ids, cuts, (within, at_end) in ((self.a, self.a_cuts, a_text), (self.b, self.b_cuts, b_text)):
            last = np.zeros(len(ids), bool)
            last[cuts - 1] = True
            sides.append((np.where(last, at_end[ids], within[ids]), np.cumsum(last) - last))
        # A's ids of a group stand before B's, and groups in their order.
        place = np.argsort(np.concatenate([2 * sides[0][1], 2 * sides[1][1] + 1]), kind="stable")
        return np.concatenate([sides[0][0], sides[1][0]])[place].tolist()

    def links(self) -> np.ndarray:
        """The ids that end together, as pair codes."""
        return self.a[self.a_cuts - 1] << 32 | self.b[self.b_cuts - 1]

    def packed(self) -> bytes:
        return packed.pack(*(x.astype(np.int64) for x in (self.a, self.b, self.a_cuts, self.b_cuts)), np.array([self.good]).astype(np.int8))

    @classmethod
    def unpacked(cls, data: bytes) -> Fragment:
        *columns, good = packed.unpack(data)
        return cls(*columns, bool(good[0]))


def composed(fragments: list[Fragment]) -> Fragment:
    """The fragment of the joined byte range."""
    a_before = np.cumsum([0, *(len(f.a) for f in fragments)])
    b_before = np.cumsum([0, *(len(f.b) for f in fragments)])
    return Fragment(
        np.concatenate([f.a for f in fragments]),
        np.concatenate([f.b for f in fragments]),
        np.concatenate([f.a_cuts + n for f, n in zip(fragments, a_before)]),
        np.concatenate([f.b_cuts + n for f, n in zip(fragments, b_before)]),
        all(f.good for f in fragments),
    )


def _byte_characters() -> dict[str, int]:
    """Byte-level vocabularies write a printable byte as itself and the others as characters from 256 on, in order."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


class Tokenizers:
    """Both tokenizers, the bytes of their ids, and the parts seen so far."""

    def __init__(self, a_path: str, b_path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import sentencepiece
        from tokenizers import Tokenizer

        self.a, self.b = Tokenizer.from_file(a_path), sentencepiece.SentencePieceProcessor(model_file=b_path)
        self.a.encode_special_tokens = True
        of_character = _byte_characters()
        tokens = sorted(self.a.get_vocab().items(), key=lambda item: item[1])
        self.a_bytes = [b""] * (tokens[-1][1] + 1)
        for token, i in tokens:
            self.a_bytes[i] = bytes(of_character[c] for c in token) if all(c in of_character for c in token) else token.encode()
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        if any(_SPACE in p.lstrip(_SPACE) for p in pieces):
            raise ValueError("a piece goes on behind a space: texts can't be taken apart there")
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(_SPACE, " ").encode() for i, p in enumerate(pieces)]
        self.a_length, self.b_length = (np.array([len(t) for t in x], np.int64) for x in (self.a_bytes, self.b_bytes))
        # An id as it is written in a group, before another id of its side and at the end of its side.
        self.a_text, self.b_text = (
            tuple(np.array([f"{i}{mark}" for i in range(len(x))], object) for mark in (",", end)) for x, end in ((self.a_bytes, "|"), (self.b_bytes, ";"))
        )
        self.forget()

    def forget(self) -> None:
        self.place: dict[str, int] = {}
        self.lines: list[str] = []
        self.sizes = np.zeros((0, 3), np.int64)  # ids of A, of B, groups of each part; (-1, 0, 0) where bytes differ
        self.links = np.zeros(0, np.int64)
        self.held = 0

    def encoded(self, data: str) -> Fragment | None:
        """The fragment of a text behind its leading space, or None where the bytes differ."""
        a = self.a.encode_batch_fast([" " + data], add_special_tokens=False)[0].ids
        b = self.b.encode(data, num_threads=1)
        raw = b" " + data.encode()
        if b"".join([self.a_bytes[i] for i in a]) != raw or b"".join([self.b_bytes[i] for i in b]) != raw:
            return None
        a, b = np.array(a, np.int64), np.array(b, np.int64)
        return Fragment.of_range(a, np.cumsum(self.a_length[a]), b, np.cumsum(self.b_length[b]), 0, len(raw))

    def learn(self, parts: Iterable[str]) -> None:
        """Parts of plain words are encoded in one text, which comes apart again where they meet; others one by one."""
        new = [p for p in dict.fromkeys(parts) if p not in self.place]
        plain = [p for p in new if p and not p[0].isspace() and p[-1] != " "]
        single = [p for p in new if not (p and not p[0].isspace() and p[-1] != " ")]
        for i in range(0, len(plain), WORDS):
            some = plain[i : i + WORDS]
            whole = self.encoded(" ".join(some))
            if whole is None:
                single += some
            else:
                ends = np.cumsum([len(p.encode()) + 1 for p in some])
                self._keep(some, whole, np.searchsorted(np.cumsum(self.a_length[whole.a])[whole.a_cuts - 1], ends, "right"))
        for p in single:
            whole = self.encoded(p)
            if whole is None:
                self._add([p], [""], np.array([[-1, 0, 0]]), self.links[:0])
            else:
                self._keep([p], whole, np.array([len(whole.a_cuts)]))

    def _keep(self, parts: list[str], whole: Fragment, stops: np.ndarray) -> None:
        """``stops``: cuts of ``whole`` up to the end of each part."""
        n_groups = np.diff(stops, prepend=0)
        n_a, n_b = (np.diff(cuts[stops - 1], prepend=0) for cuts in (whole.a_cuts, whole.b_cuts))
        written = whole.written(self.a_text, self.b_text)
        ends = np.cumsum(n_a + n_b).tolist()
        self._add(parts, ["".join(written[i:j]) for i, j in zip([0, *ends], ends)], np.stack([n_a, n_b, n_groups], axis=1), whole.links())

    def _add(self, parts: list[str], lines: list[str], sizes: np.ndarray, links: np.ndarray) -> None:
        self.place.update(zip(parts, range(len(self.lines), len(self.lines) + len(parts))))
        self.lines += lines
        self.sizes, self.links = np.concatenate([self.sizes, sizes]), np.concatenate([self.links, links])
        self.held += sum(map(len, parts))


@lru_cache(maxsize=1)
def tokenizers(a_path: str, b_path: str) -> Tokenizers:
    return Tokenizers(a_path, b_path)


def public_paths() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


#: One text's figures: id, ids of A, of B, groups, digest of the groups, links as pair codes.
Aligned = tuple[int | None, int, int, int, str, np.ndarray]
_NOTHING = (0, 0, 0, "", np.zeros(0, np.int64))


def _short(t: Tokenizers, ids: list[int | None], texts: list[str | None]) -> Iterator[Aligned]:
    """Texts by their parts; equal parts are looked up."""
    if t.held > REMEMBERED:
        t.forget()
    parts = [_CUT.split(x) if x else [] for x in texts]
    t.learn(p for some in parts for p in some)
    starts = np.cumsum(t.sizes[:, 2]) - t.sizes[:, 2]
    for i, some in zip(ids, parts):
        places = [t.place[p] for p in some]
        sizes = t.sizes[places]
        if not places or sizes[:, 0].min() < 0:
            yield (i, *_NOTHING)
            continue
        n_a, n_b, n_groups = sizes.sum(axis=0).tolist()
        digest = hashlib.sha256("".join([t.lines[p] for p in places])[:-1].encode()).hexdigest()
        n = sizes[:, 2]
        where = np.arange(n_groups) + np.repeat(starts[places] - np.cumsum(n) + n, n)
        yield i, n_a, n_b, n_groups, digest, t.links[where]


def _long(t: Tokenizers, rows: Iterable[tuple[int | None, Fragment]]) -> Iterator[Aligned]:
    for i, f in rows:
        if not f.good or not len(f.a):
            yield (i, *_NOTHING)
            continue
        digest, written = hashlib.sha256(), f.written(t.a_text, t.b_text)
        written[-1] = written[-1][:-1]
        for at in range(0, len(written), WORDS):
            digest.update("".join(written[at : at + WORDS]).encode())
        yield i, len(f.a), len(f.b), len(f.a_cuts), digest.hexdigest(), f.links()


def _tables(texts: Iterator[Aligned]) -> Iterator[pa.RecordBatch]:
    """Rows of ``_FOUND``: some texts share a table of their pairs, and name a link by the pair's number there."""
    context, made = TaskContext.get(), 0
    schema = pa.schema([("table", pa.string()), ("kind", pa.int32()), *((c, pa.int64()) for c in ("number", "a", "b", "n")), ("data", pa.binary())])

    def rows(some: list[Aligned]) -> pa.RecordBatch:
        nonlocal made
        codes, where, n = np.unique(np.concatenate([x[5] for x in some]), return_inverse=True, return_counts=True)
        name = f"{context.stageId()}-{context.partitionId()}-{made}"
        made += 1
        ids = np.array([x[0] or 0 for x in some], np.int64)
        known = np.array([x[0] is not None for x in some]).astype(np.int8)
        figures = [np.array([x[k] for x in some], np.int64) for k in (1, 2, 3)]
        digests = np.frombuffer(b"".join(bytes.fromhex(x[4]) if x[4] else bytes(32) for x in some), np.uint8)
        data = packed.pack(ids, known, *figures, digests, np.array([len(x[5]) for x in some], np.int64), where.astype(np.int32))
        size = len(codes) + 1
        text_row = lambda numbers: pa.array(np.append(numbers, 0), pa.int64())
        return pa.RecordBatch.from_arrays(
            [
                pa.array([name] * size), pa.array(np.append(np.zeros(len(codes), np.int32), 1), pa.int32()), text_row(np.arange(len(codes))),
                text_row(codes >> 32), text_row(codes & 0xFFFFFFFF), text_row(n), pa.array([None] * len(codes) + [data], pa.binary()),
            ],
            schema=schema,
        )

    held, some = 0, []
    for x in texts:
        some.append(x)
        held += 64 + 8 * len(x[5])
        if held > TOGETHER:
            yield rows(some)
            held, some = 0, []
    if some:
        yield rows(some)


def _groups_of(batch: pa.RecordBatch, limit: int) -> Iterator[tuple[list, list]]:
    """Ids and texts, about ``limit`` code points at a time."""
    ids, texts, start, held = batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), 0, 0
    for i, text in enumerate(texts):
        held += len(text or "") + 64
        if held > limit:
            yield ids[start : i + 1], texts[start : i + 1]
            start, held = i + 1, 0
    if start < len(ids):
        yield ids[start:], texts[start:]


def _ranges(text: str, size: int) -> Iterator[str]:
    """The text in ranges of about ``size`` code points, each but the first without the space it starts with."""
    start = 0
    while start < len(text):
        cut = _CUT.search(text, start + size) if start + size < len(text) else None
        yield text[start : cut.start()] if cut else text[start:]
        start = cut.end() if cut else len(text)


def _fragments(docs: DataFrame, paths: tuple[str, str], size: int) -> DataFrame:
    """(row, doc_id, data): one packed fragment for every text, composed in rounds of ``FAN_IN`` from those of its ranges."""
    names = ["row", "doc_id", "number", "text"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context, row = TaskContext.get(), 0
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                row += 1
                for number, part in enumerate(_ranges(text, size)):
                    columns = [[f"{context.partitionId()}-{row}"], [doc_id], [number], [part]]
                    types = (pa.string(), pa.int64(), pa.int64(), pa.string())
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = tokenizers(*paths)
        for batch in batches:
            for i in range(batch.num_rows):
                whole = t.encoded(batch.column("text")[i].as_py())
                if whole is None:
                    whole = Fragment.none()
                    whole.good = False
                columns = [*(batch.column(c).slice(i, 1) for c in names[:3]), pa.array([whole.packed()], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, [*names[:3], "data"])

    def compose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def done() -> pa.RecordBatch:
            columns = [[key[0]], [doc_id], [key[1]], [composed(held).packed()]]
            types = (pa.string(), pa.int64(), pa.int64(), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], [*names[:3], "data"])

        key, doc_id, held = None, None, []
        for batch in batches:
            for row, own_id, number, data in zip(*(batch.column(c) for c in (*names[:3], "data"))):
                now = (row.as_py(), number.as_py() // FAN_IN)
                if now != key and key is not None:
                    yield done()
                    held = []
                key, doc_id = now, own_id.as_py()
                held.append(Fragment.unpacked(data.as_py()))
        if held:
            yield done()

    # Written once, as a task that is run again may see its rows in another order and number them anew.
    texts = stored(docs.mapInArrow(cut, "row string, doc_id long, number long, text string"), "ranges")
    schema = "row string, doc_id long, number long, data binary"
    fragments = texts.repartition("row", "number").mapInArrow(align, schema)
    last = texts.agg(F.max("number")).first()[0] or 0
    while last > 0:
        last //= FAN_IN
        step = F.floor(F.col("number") / FAN_IN)
        fragments = fragments.repartition(F.col("row"), step).sortWithinPartitions("row", "number").mapInArrow(compose, schema)
    return fragments


def align(docs: DataFrame, paths: tuple[str, str] | None = None, id_col: str = "doc_id", text_col: str = "text", size: int = RANGE) -> DataFrame:
    """One row per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    A link is a pair of ids that end at the same byte. ``n_best`` counts the links whose pair is, in all documents, as
    frequent as any with its id of B; ``count_sum`` adds up how often each link's pair is linked in all documents.
    Texts that are null or empty, or that a tokenizer doesn't give back byte by byte, have zeros and an empty digest.
    Every row has its own result, repeated rows and rows without an id too, and counts. An empty table gives an
    empty table. Other columns play no part. Memory: a text's ids, as its text, are held by one task in the end.
    """
    paths = paths or public_paths()

    def short(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = tokenizers(*paths)
        yield from _tables(x for batch in batches for group in _groups_of(batch, TEXTS) for x in _short(t, *group))

    def long(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = tokenizers(*paths)
        columns = (zip(batch.column("doc_id"), batch.column("data")) for batch in batches)
        fragments = ((i.as_py(), Fragment.unpacked(data.as_py())) for rows in columns for i, data in rows)
        yield from _tables(_long(t, fragments))

    rows = keyed(docs, id_col, text_col)
    is_long = F.coalesce(F.length("text") > size, F.lit(False))
    found = rows.where(~is_long).mapInArrow(short, _FOUND).union(_fragments(rows.where(is_long), paths, size).mapInArrow(long, _FOUND))
    found = stored(found, "aligned")
    pairs = found.where("kind = 0").select("table", "number", "a", "b", "n")
    totals = pairs.groupBy("a", "b").agg(F.sum("n").alias("total"))
    most = totals.groupBy("b").agg(F.max("total").alias("most"))  # a row for each id of B: its vocabulary bounds them
    totals = totals.join(F.broadcast(most), "b").select("a", "b", "total", (F.col("total") == F.col("most")).cast("long").alias("best"))
    back = pairs.join(totals, ["a", "b"]).select("table", F.lit(0).alias("kind"), "number", "total", "best", F.lit(None).cast("binary").alias("data"))
    nothing = F.lit(None).cast("long")
    texts = found.where("kind = 1").select("table", F.lit(1).alias("kind"), "number", nothing.alias("total"), nothing.alias("best"), "data")
    stream = back.union(texts).repartition("table").sortWithinPartitions("table", "kind", "number")
    return stream.mapInArrow(_judged, _RESULT)


_RESULT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def _judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Results from tables whose pairs come first, in order, and then their texts."""
    names = [c.split()[0] for c in _RESULT.split(", ")]
    totals, best = [], []
    for batch in batches:
        if not batch.num_rows:
            continue
        kinds = batch.column("kind").to_numpy()
        at = 0
        for stop in [*np.flatnonzero(kinds == 1).tolist(), len(kinds)]:
            if stop > at:
                totals.append(batch.column("total").slice(at, stop - at).to_numpy())
                best.append(batch.column("best").slice(at, stop - at).to_numpy())
            at = stop + 1
            if stop == len(kinds):
                break
            ids, known, n_a, n_b, n_groups, digests, lengths, where = packed.unpack(batch.column("data")[stop].as_py())
            ends = np.concatenate(([0], np.cumsum(lengths)))
            sums = []
            for parts in (best, totals):
                values = np.concatenate(parts) if parts else np.zeros(0, np.int64)
                before = np.concatenate(([0], np.cumsum(values[where])))
                sums.append(before[ends[1:]] - before[ends[:-1]])
            hexes = [d.tobytes().hex() if n else "" for d, n in zip(digests.reshape(-1, 32), n_a.tolist())]
            columns = [pa.array(ids, mask=known == 0), *map(pa.array, (n_a, n_b, n_groups, lengths, *sums)), pa.array(hexes, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names)
            totals, best = [], []
