"""Packing tokenised documents into sequences: vector bin packing by dot products.

A sequence has limits on tokens, on segments and on tokens that bear loss. The
next piece to place is the one that fits and whose share of the three limits
has the greatest dot product with what is left of them: a piece that uses most of
what the sequence has most of. Where no whole piece fits, one is cut. Every
partition packs its own rows as they stream by, with a bounded number of open pieces,
so that nothing is shuffled.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

#: Open pieces that a task keeps.
OPEN = 512

#: A process remembers the ids of twice as many words at most, none of more bytes.
REMEMBERED, LONGEST = 150_000, 40

#: Bytes of texts that are tokenised together, and of ids that are handed on together.
TOGETHER, OUT = 4 << 20, 2 << 20

SCHEMA = "doc_id long, start long, length long, ids binary, doc_tokens long, loss_tokens long, sequence_id long, offset long"


#: Words that only change by lower-casing, letter by letter, when normalised; and the parts that the tokenizer makes of them, line by line.
PLAIN = re.compile("[!-~À-ÖØ-öø-ÿА-я一-龥]+")
PARTS = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿа-я一-龥]+|[0-9]|\n|[^a-zß-öø-ÿа-я一-龥0-9\n]+")


def byte_letters() -> np.ndarray:
    """Code points of the letters that stand for bytes in the tokenizer's vocabulary; a space stays one."""
    letters = np.arange(256, dtype="<u4")
    others = np.setdiff1d(letters, [*range(33, 127), *range(161, 173), *range(174, 256)])
    letters[others] = 256 + np.arange(len(others))
    letters[32] = 32
    return letters


class WordIds:
    """Ids of texts as little-endian unsigned 32-bit numbers.

    The tokenizer never joins what ASCII white space parts, so the ids of a text
    are those of its words in turn. Many texts are split at once, and each
    different word is looked up once among those seen lately. New words that are
    ``PLAIN`` are cut into parts here and go through the tokenizer's model
    alone; others go through the whole tokenizer in one text, between marks
    that it keeps apart from any text.
    """

    MARK, SOME, LETTERS = "<|startoftext|>", 1000, byte_letters()

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.model = Tokenizer(self.tokenizer.model)
        self.model.normalizer, self.model.pre_tokenizer = normalizers.Sequence([]), pre_tokenizers.WhitespaceSplit()
        self.mark = self.tokenizer.token_to_id(self.MARK)
        #: Tokens that end a part.
        self.last = np.zeros(self.tokenizer.get_vocab_size(), bool)
        self.last[[i for token, i in self.tokenizer.get_vocab().items() if token.endswith("</w>")]] = True
        self.recent: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}

    def of(self, texts: list[bytes]) -> list[bytes]:
        return self.of_column(pa.array(texts, pa.binary()).cast(pa.string()))

    def of_column(self, texts: pa.Array) -> list[bytes]:
        """Ids of each text; a null has none."""
        nothing = pa.scalar("", texts.type)
        texts = pc.fill_null(texts, nothing)
        if self.mark is None:
            return [self.plain(t) for t in texts.to_pylist()]
        marked = pc.match_substring(texts, "<|")
        lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.if_else(marked, nothing, texts)))
        words = lists.flatten().dictionary_encode()
        found = pa.array(self.of_words(words.dictionary.cast(pa.binary()).to_pylist()), pa.large_binary())
        ids = found.take(words.indices)
        _, stops, raw = ids.buffers()
        ends = np.frombuffer(stops, np.int64)[lists.offsets.to_numpy()].tolist() if len(ids) else [0] * (len(texts) + 1)
        raw = memoryview(raw or b"")
        out = [raw[a:b].tobytes() for a, b in zip(ends, ends[1:])]
        for i in np.flatnonzero(marked.to_numpy(zero_copy_only=False)).tolist():
            out[i] = self.plain(texts[i].as_py())
        return out

    def of_words(self, words: list[bytes]) -> list[bytes]:
        """Ids of different words in lower case."""
        out = list(map(self.recent.get, words))
        absent = [i for i, ids in enumerate(out) if ids is None]
        for i in absent:
            out[i] = self.older.pop(words[i], None)
        new = [i for i in absent if out[i] is None]
        plain = [i for i in new if PLAIN.fullmatch(words[i].decode())]
        for own, learn in ((plain, self.learn), (sorted(set(new).difference(plain)), self.learn_marked)):
            for some in (own[k : k + self.SOME] for k in range(0, len(own), self.SOME)):
                for i, ids in zip(some, learn([words[i] for i in some])):
                    out[i] = ids
        self.recent.update((words[i], out[i]) for i in absent if len(words[i]) <= LONGEST)
        if len(self.recent) > REMEMBERED:
            self.older, self.recent = self.recent, {}
        return out

    def plain(self, text: str) -> bytes:
        return np.asarray(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def learn(self, words: list[bytes]) -> list[bytes]:
        """Ids of words that are ``PLAIN``; the model ends each part with a token of its own."""
        parts = PARTS.findall(b"\n".join(words).decode().lower())
        breaks = np.array([i for i, part in enumerate(parts) if part == "\n"], int)
        text = " ".join([part for part in parts if part != "\n"])
        if not text.isascii():
            text = self.LETTERS[np.frombuffer(text.encode(), np.uint8)].tobytes().decode("utf-32-le")
        ids = np.asarray(self.model.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")
        stops = np.flatnonzero(self.last[ids]) + 1
        if len(stops) != len(parts) - len(breaks):
            return self.learn_marked(words)
        return self.sliced(ids, stops[np.append(breaks - np.arange(len(breaks)), len(stops)) - 1])

    def learn_marked(self, words: list[bytes]) -> list[bytes]:
        ids = np.frombuffer(self.plain("".join(self.MARK + w.decode() for w in words)), "<u4")
        marks = np.flatnonzero(ids == self.mark)
        return self.sliced(np.delete(ids, marks), np.append(marks[1:] - np.arange(1, len(marks)), len(ids) - len(marks)))

    @staticmethod
    def sliced(ids: np.ndarray, stops: np.ndarray) -> list[bytes]:
        raw, ends = ids.tobytes(), (4 * stops).tolist()
        return [raw[a:b] for a, b in zip([0, *ends[:-1]], ends)]


@lru_cache(maxsize=2)
def word_ids(path: str) -> WordIds:
    return WordIds(path)


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class Piece:
    """Ids ``start`` to ``stop`` of a document; those from ``loss_from`` on bear loss."""

    __slots__ = ("doc_id", "ids", "loss_from", "start", "stop", "total")

    def __init__(self, doc_id, ids: memoryview, start: int, stop: int, loss_from: int, total: int):
        self.doc_id, self.ids, self.start, self.stop, self.loss_from, self.total = doc_id, ids, start, stop, loss_from, total

    def loss(self) -> int:
        return max(0, self.stop - max(self.start, self.loss_from))

    def fitting(self, tokens: int, loss: int) -> int:
        """Ids of the longest front that keeps to both limits."""
        free = max(0, self.loss_from - self.start)
        return max(0, min(self.stop - self.start, tokens, free + loss))

    def alone(self) -> Piece:
        """Its ids apart from those of the rest of its document, which needn't stay in memory with them."""
        self.ids = memoryview(bytes(self.ids))
        return self

    def cut(self, n: int) -> tuple[Piece, Piece | None]:
        if n == self.stop - self.start:
            return self, None
        at = self.start + n
        front = Piece(self.doc_id, self.ids[: 4 * n], self.start, at, self.loss_from, self.total)
        return front, Piece(self.doc_id, self.ids[4 * n :], at, self.stop, self.loss_from, self.total)


class Packer:
    def __init__(self, tokens: int, segments: int, loss: int):
        self.limits = np.array([tokens, segments, loss], float)
        self.tokens, self.segments, self.loss = tokens, segments, loss
        self.open: list[Piece] = []
        self.shape = np.ones((0, 3))

    def add(self, piece: Piece) -> None:
        self.open.append(piece)
        self.shape = np.vstack([self.shape, [[piece.stop - piece.start, 1, piece.loss()]]])

    def _take(self, i: int) -> Piece:
        self.open[i], piece = self.open[-1], self.open[i]
        self.open.pop()
        self.shape[i] = self.shape[-1]
        self.shape = self.shape[:-1]
        return piece

    def sequence(self) -> list[Piece]:
        """The next sequence. Its length is the token limit or a power of two, so that it needs no padding."""
        waiting = int(self.shape[:, 0].sum())
        room = self.tokens if waiting >= self.tokens else 1 << (waiting.bit_length() - 1)
        left, out = np.array([room, self.segments, self.loss], float), []
        while self.open and left[0] > 0 and left[1] > 0:
            tokens, segments, loss = self.shape.T
            fits = (tokens <= left[0]) & (segments <= left[1]) & (loss <= left[2])
            if fits.any():
                gain = (self.shape / self.limits) @ (left / self.limits)
                piece = self._take(int(np.argmax(np.where(fits, gain, -1.0))))
            else:
                fronts = np.minimum(np.minimum(tokens, left[0]), tokens - loss + left[2])  # as ``Piece.fitting``
                i = int(np.argmax(fronts))
                if not fronts[i]:
                    break
                piece, rest = self._take(i).cut(int(fronts[i]))
                if rest:
                    self.add(rest)
            out.append(piece)
            left -= [piece.stop - piece.start, 1, piece.loss()]
        self._trim(out)
        return out

    def _trim(self, out: list[Piece]) -> None:
        """Where segments or loss ended a sequence early, what lies over a power of two waits for another."""
        length = sum(p.stop - p.start for p in out)
        over = 0 if length == self.tokens else length - (1 << (length.bit_length() - 1))
        while over:
            last = out.pop()
            n = last.stop - last.start
            if n > over:
                last, rest = last.cut(n - over)
                out.append(last)
                self.add(rest)
                over = 0
            else:
                self.add(last)
                over -= n


def pack(
    docs: DataFrame,
    path: str | None = None,
    max_tokens: int = 4096,
    max_segments: int = 256,
    max_loss_tokens: int | None = None,
    end_id: int = 2,
) -> DataFrame:
    """One row per piece of a document: doc_id, start, length, ids, doc_tokens, loss_tokens, sequence_id, offset.

    ``docs`` has doc_id and text, and may have ``loss_from``: how many of a
    document's first ids bear no loss (an instruction's prompt); null or no such
    column: all bear loss. A document is its text's ids and ``end_id``; a
    null or empty text is the end id alone. ``ids`` are little-endian unsigned
    32-bit numbers. No sequence has over ``max_tokens`` ids,
    ``max_segments`` pieces or ``max_loss_tokens`` (default: no limit of its own)
    ids that bear loss, and each is ``max_tokens`` or a power of two long.
    Repeated rows are packed each for itself; a null doc_id stays null. Other
    columns play no part. An empty table gives an empty table. A task's
    memory is one batch of rows, ``OPEN`` pieces of under ``max_tokens`` ids and the
    remembered words.
    """
    path = path or tokenizer_path()
    loss_limit = max_tokens if max_loss_tokens is None else max_loss_tokens
    if min(max_tokens, max_segments, loss_limit) < 1:
        raise ValueError("limits must be 1 or more")
    column = F.col("loss_from") if "loss_from" in docs.columns else F.lit(0)
    rows = docs.select(F.col("doc_id").cast("long"), "text", F.greatest(F.coalesce(column, F.lit(0)), F.lit(0)).cast("long").alias("loss_from"))
    names = [part.split()[0] for part in SCHEMA.split(", ")]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of, packer = word_ids(path), Packer(max_tokens, max_segments, loss_limit)
        end = np.array([end_id], "<u4").tobytes()
        number = TaskContext.get().partitionId() << 40

        def rows_of(pieces: list[Piece]) -> list[tuple]:
            nonlocal number
            offset, out = 0, []
            for p in pieces:
                n = p.stop - p.start
                out.append((p.doc_id, p.start, n, bytes(p.ids), p.total, p.loss(), number, offset))
                offset += n
            number += 1
            return out

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            types = [pa.binary() if n == "ids" else pa.int64() for n in names]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

        def tokenised(batch: pa.RecordBatch) -> Iterator[tuple]:
            texts = batch.column(1)
            sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
            cuts = np.flatnonzero(np.diff(np.cumsum(sizes, dtype=np.int64) // TOGETHER)) + 1
            for start, stop in pairwise([0, *cuts.tolist(), len(batch)]):
                doc_ids, loss = (batch.column(k).slice(start, stop - start).to_pylist() for k in (0, 2))
                yield from zip(doc_ids, ids_of.of_column(texts.slice(start, stop - start)), loss)

        def pieces_of(batch: pa.RecordBatch) -> Iterator[list[Piece]]:
            for doc_id, ids, loss_from in tokenised(batch):
                ids = memoryview(ids + end)
                rest: Piece | None = Piece(doc_id, ids, 0, len(ids) // 4, loss_from, len(ids) // 4)
                while rest and rest.fitting(max_tokens, loss_limit) == max_tokens:
                    full, rest = rest.cut(max_tokens)
                    yield [full]
                while rest:
                    # Beyond the loss limit no single sequence could hold it whole.
                    part, rest = rest.cut(rest.fitting(max_tokens, loss_limit))
                    packer.add(part.alone())
                if len(packer.open) > OPEN:
                    while len(packer.open) > OPEN // 2:
                        yield packer.sequence()

        def sequences() -> Iterator[list[Piece]]:
            for batch in batches:
                yield from pieces_of(batch)
            while packer.open:
                yield packer.sequence()

        done: list[tuple] = []
        held = 0
        for pieces in sequences():
            done += rows_of(pieces)
            held += 4 * sum(p.stop - p.start for p in pieces)
            if held > OUT or len(done) > 2000:
                yield batch_of(done)
                done, held = [], 0
        if done:
            yield batch_of(done)

    return rows.mapInArrow(scan, SCHEMA)
