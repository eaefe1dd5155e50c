"""Repeated passages of words, found on the De Bruijn graph of token k-mers.

Every window of k words is an edge from its first to its last k - 1 words. Edges
are brought together by hash, and each that also starts in a document of smaller
id gets the coordinates (document, position) of such a source. Where a
document's next edges follow their sources' next edges, the path does not
branch, and the edges compact into one walk with one pair of coordinates; like walks of
different documents compact into one path with a join. Each walk is then verified: the words
at its own coordinates must be those at its source's.

What travels are packed numbers: eight bytes of hash and about one of position for each edge. In a
task, an edge that repeats one of a smaller id that the same task has seen is settled
there, so that one passage in a third of all documents is sent once per task, not once per document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from panelkiln.llm import packed
from panelkiln.llm.common import keyed, shuffle_parts, text_key, utf8
from panelkiln.session import stored

K = 13

#: Words that a task gathers before it sends their edges.
GATHER = 1_500_000

_EDGES, _SOURCES = 0, 1
_WALKS = "doc_id long, tag int, start int, n int, source_id long, source_tag int, source_start int"


def _tag(text: Column) -> Column:
    """Tells rows of one id apart: half of the text's hash."""
    return F.coalesce(text_key(text), F.lit(0)).bitwiseAND(F.lit(0x7FFFFFFF)).cast("int")


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


def edge_hashes(words: np.ndarray, k: int, seed: int) -> np.ndarray:
    """Of every window of k words; odd random weights tell positions apart."""
    weights = np.random.default_rng(seed).integers(1 << 62, size=k, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    n = len(words) - k + 1
    total = words[:n] * weights[0]
    for j in range(1, k):
        total += words[j : n + j] * weights[j]
    return packed.mixed(total)


def _edges(docs: list[tuple[int, int, np.ndarray]], k: int, parts: int) -> Iterator[tuple[int, int, bytes]]:
    """Packed rows of some documents' edges, and of the sources found among themselves."""
    docs = sorted((d for d in docs if len(d[2]) >= k), key=lambda d: d[:2])
    if not docs:
        return
    ids, tags = np.array([d[0] for d in docs], np.int64), np.array([d[1] for d in docs], np.int32)
    lengths = np.array([len(d[2]) for d in docs])
    words = np.concatenate([d[2] for d in docs])
    doc = np.repeat(np.arange(len(docs), dtype=np.int32), lengths)
    at = (np.arange(len(words)) - np.repeat(np.cumsum(lengths) - lengths, lengths)).astype(np.int32)
    inside = np.flatnonzero(doc[: len(words) - k + 1] == doc[k - 1 :])
    doc, at = doc[inside], at[inside]
    hashes, route = edge_hashes(words, k, 1)[inside], edge_hashes(words, k, 2)[inside]
    del words, inside

    order = np.argsort(hashes, kind="stable")
    new = np.empty(len(order), bool)
    new[:1], new[1:] = True, hashes[order][1:] != hashes[order][:-1]
    leader = np.empty(len(order), np.int64)
    leader[order] = order[np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))]
    del order, new
    settled = np.flatnonzero((ids[doc[leader]] < ids[doc]) & (route[leader] == route))
    yield from _sources(ids[doc[settled]], tags[doc[settled]], at[settled], *(x[leader[settled]] for x in (ids[doc], tags[doc], at)), parts)
    open_ = np.ones(len(doc), bool)
    open_[settled] = False
    open_ = np.flatnonzero(open_)
    hashes, doc, at = hashes[open_], doc[open_], at[open_]
    for part, where in packed.dealt(packed.spread(route[open_], parts)):
        d, a = doc[where], at[where]
        first = np.flatnonzero(np.diff(d, prepend=-1))
        gaps = np.diff(a, prepend=0)
        gaps[first] = a[first]
        counts = np.diff(first, append=len(d)).astype(np.int32)
        yield part, _EDGES, packed.pack(hashes[where], gaps.astype(np.int32), ids[d[first]], tags[d[first]], counts)


def _sources(ids, tags, at, source_ids, source_tags, source_at, parts: int) -> Iterator[tuple[int, int, bytes]]:
    """Packed rows that tell documents which of their edges have a source, and where."""
    order = np.lexsort((at, tags, ids))
    ids, tags, at = ids[order], tags[order], at[order]
    source_ids, source_tags, shift = source_ids[order], source_tags[order], (source_at[order] - at).astype(np.int32)
    for part, where in packed.dealt(packed.spread(packed.mixed(ids.astype(np.uint64)), parts)):
        steps = (np.diff(x[where], prepend=x.dtype.type(0)) for x in (ids, tags, at, source_ids, source_tags, shift))
        yield part, _SOURCES, packed.pack(*steps)


def _meet(blobs: list[bytes], parts: int) -> Iterator[tuple[int, int, bytes]]:
    """Edges of one part, from everywhere: those with a source of smaller id."""
    if not blobs:
        return
    hashes, gaps, ids, tags, counts = packed.joined([packed.unpack(b) for b in blobs], 5)
    doc = np.repeat(np.arange(len(ids), dtype=np.int32), counts)
    ends = np.cumsum(counts)
    walked = np.cumsum(gaps.astype(np.int64))
    before = walked[ends - counts] - gaps[ends - counts]
    at = (walked - np.repeat(before, counts)).astype(np.int32)
    del gaps, walked
    order = np.argsort(hashes, kind="stable")
    same = hashes[order][1:] == hashes[order][:-1]
    twice = np.zeros(len(order), bool)
    twice[1:] = same
    twice[:-1] |= same
    twice = order[twice]
    hashes, doc, at = hashes[twice], doc[twice], at[twice]
    order = np.lexsort((at, tags[doc], ids[doc], hashes))
    hashes, doc, at = hashes[order], doc[order], at[order]
    new = np.ones(len(hashes), bool)
    new[1:] = hashes[1:] != hashes[:-1]
    leader = np.maximum.accumulate(np.where(new, np.arange(len(hashes)), 0))
    found = np.flatnonzero(ids[doc[leader]] < ids[doc])
    to = leader[found]
    yield from _sources(ids[doc[found]], tags[doc[found]], at[found], ids[doc[to]], tags[doc[to]], at[to], parts)


def _compact(blobs: list[bytes]) -> list[np.ndarray]:
    """Walks of some documents: edges whose own and source's coordinates go on together."""
    columns = [[np.cumsum(c, dtype=c.dtype) for c in packed.unpack(b)] for b in blobs]
    ids, tags, at, source_ids, source_tags, shift = packed.joined(columns, 6)
    order = np.lexsort((at, tags, ids))
    ids, tags, at, source_ids, source_tags, shift = (x[order] for x in (ids, tags, at, source_ids, source_tags, shift))
    # Copies of a row send the same edges more than once.
    new = np.ones(len(ids), bool)
    new[1:] = (at[1:] != at[:-1]) | (ids[1:] != ids[:-1]) | (tags[1:] != tags[:-1])
    ids, tags, at, source_ids, source_tags, shift = (x[new] for x in (ids, tags, at, source_ids, source_tags, shift))
    goes_on = np.zeros(len(ids), bool)
    goes_on[1:] = at[1:] == at[:-1] + 1
    for x in (ids, tags, source_ids, source_tags, shift):
        goes_on[1:] &= x[1:] == x[:-1]
    first = np.flatnonzero(~goes_on)
    n = np.diff(first, append=len(ids)).astype(np.int32)
    return [ids[first], tags[first], at[first], n, source_ids[first], source_tags[first], (at[first] + shift[first]).astype(np.int32)]


def walks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K) -> DataFrame:
    """Runs of ``n`` edges of a document that repeat a run of a document with a smaller id, in the columns of ``_WALKS``."""
    parts = shuffle_parts(docs.sparkSession)
    rows = keyed(docs, id_col, text_col).where("doc_id is not null and text is not null").withColumn("tag", _tag(F.col("text")))

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found() -> Iterator[tuple[int, int, bytes]]:
            held, size = [], 0
            for batch in batches:
                columns = batch.column("doc_id").to_pylist(), batch.column("tag").to_pylist(), batch.column("text").cast(pa.binary())
                for doc_id, tag, text in zip(*columns):
                    words = word_hashes(text.as_py().split())
                    held.append((doc_id, tag, words))
                    size += len(words)
                    if size >= GATHER:
                        yield from _edges(held, k, parts)
                        held, size = [], 0
            yield from _edges(held, k, parts)

        return packed.rows(found())

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found() -> Iterator[tuple[int, int, bytes]]:
            here = []
            for batch in batches:
                for part, kind, data in zip(*(batch.column(i).to_pylist() for i in range(3))):
                    if kind == _EDGES:
                        here.append(data)
                    else:
                        yield part, kind, data
            yield from _meet(here, parts)

        return packed.rows(found())

    def compact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blobs = [data for batch in batches for data in batch.column(2).to_pylist()]
        if blobs:
            names = [part.split()[0] for part in _WALKS.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in _compact(blobs)], names)

    sent = rows.mapInArrow(send, packed.SCHEMA).repartitionById(parts, F.col("part"))
    met = sent.mapInArrow(meet, packed.SCHEMA).repartitionById(parts, F.col("part"))
    return met.mapInArrow(compact, _WALKS)


def _words_at(words: list[bytes], start: int, n: int, k: int) -> int:
    """Digest of the words under n edges; signed."""
    return xxhash.xxh3_64_intdigest(b" ".join(words[start : start + n + k - 1])) - (1 << 63)


_PATH = ["source_id", "source_tag", "source_start", "n"]


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept_text, spans.

    A word goes if it is in a window of ``k`` words that also starts in a document of
    smaller id, both as they came in; ``kept_text`` is the rest joined by single spaces,
    ``spans`` are the maximal removed runs (first word, end). A null text has no
    words. A row without an id takes no part: it keeps its words and is nobody's
    source. Rows of one id are judged each for itself, neither is smaller. Other
    columns play no part; an empty table gives an empty table.
    """
    found = stored(walks(docs, id_col, text_col, k), "walks")
    rows = keyed(docs, id_col, text_col).withColumn("tag", _tag(F.col("text")))

    def with_text(asked: DataFrame) -> DataFrame:
        """Texts next to what is asked of them. Both uses share one shuffle of the texts, as they are alike."""
        asked = asked.select(F.col("doc_id").alias("a_id"), F.col("tag").alias("a_tag"), "asked")
        on = (rows.doc_id == asked.a_id) & (rows.tag == asked.a_tag)
        return rows.join(asked, on, "left").select("doc_id", "tag", "text", "asked")

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, types = [*_PATH, "digest"], [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64()]
        for batch in batches:
            out = []
            for text, asked in zip(batch.column("text").cast(pa.binary()), batch.column("asked")):
                if not asked.is_valid:
                    continue
                words = text.as_py().split()
                out += [(*(a[c] for c in _PATH), _words_at(words, a["start"], a["n"], k)) for a in asked.as_py()]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)

    own = found.select("doc_id", "tag", F.struct("start", *_PATH).alias("one"))
    # Like walks compact into one path, whose words are looked up once.
    paths = found.select(*_PATH).distinct()
    at_source = paths.select(
        F.col("source_id").alias("doc_id"), F.col("source_tag").alias("tag"), F.struct(F.col("source_start").alias("start"), *_PATH).alias("one")
    )
    asked = own.union(at_source).groupBy("doc_id", "tag").agg(F.collect_list("one").alias("asked"))
    seen = with_text(asked).mapInArrow(digests, "source_id long, source_tag int, source_start int, n int, digest long")
    # A path is verified with all walks that compacted into it: their words' digests are one. As hashes
    # seldom collide, the paths that fail are few or none, and dealt out anew the join with them is small.
    failed = seen.groupBy(*_PATH).agg(F.min("digest").alias("low"), F.max("digest").alias("high")).where("low <> high")
    sure = found.join(failed.select(*_PATH).repartition(*_PATH), _PATH, "left_anti")
    spans = sure.groupBy("doc_id", "tag").agg(F.collect_list(F.struct("start", "n")).alias("asked"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "n_words", "n_removed", "kept_text", "spans"]
        run = pa.list_(pa.struct([("first", pa.int64()), ("stop", pa.int64())]))
        for batch in batches:
            counts, removed, kept, runs = [], [], [], []
            for text, asked in zip(utf8(batch.column("text")), batch.column("asked").to_pylist()):
                words, own, left, at = (text or b"").split(), [], [], 0
                for start, n in sorted((a["start"], a["n"]) for a in asked or ()):
                    stop = start + n + k - 1
                    if own and start <= own[-1]["stop"]:
                        own[-1]["stop"] = max(stop, own[-1]["stop"])
                    else:
                        own.append({"first": start, "stop": stop})
                for r in own:
                    left += words[at : r["first"]]
                    at = r["stop"]
                left += words[at:]
                counts.append(len(words))
                removed.append(len(words) - len(left))
                kept.append(b" ".join(left).decode())
                runs.append(own)
            arrays = [pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string()), pa.array(runs, run)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *arrays], names)

    schema = "doc_id long, n_words long, n_removed long, kept_text string, spans array<struct<first: long, stop: long>>"
    return with_text(spans).mapInArrow(cut, schema)


#: DuckDB's way to the rows of the query, window by window.
SQL = f"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, [x FOR x IN regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+') IF x <> ''] AS w FROM documents),
windows AS (
  SELECT r, doc_id, i, array_to_string(w[i:i + {K - 1}], ' ') AS s
  FROM (SELECT *, unnest(range(1, len(w) - {K - 2})) AS i FROM d WHERE doc_id IS NOT NULL AND len(w) >= {K})),
firsts AS (SELECT s, min(doc_id) AS first_id FROM windows GROUP BY s),
gone AS (SELECT DISTINCT r, unnest(range(i, i + {K})) AS j FROM windows JOIN firsts USING (s) WHERE first_id < doc_id),
words AS (SELECT r, j, w[j] AS word FROM (SELECT r, w, unnest(range(1, len(w) + 1)) AS j FROM d)),
kept AS (SELECT r, count(*) AS n, string_agg(word, ' ' ORDER BY j) AS text FROM words ANTI JOIN gone USING (r, j) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (r)
"""
