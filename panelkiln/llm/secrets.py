"""Secret scans through a trigram index.

Each rule's regular expression gives a Boolean query of trigrams that any match
must contain. A batch of documents is one segment of the index: for every trigram
that some rule asks for, its postings are the documents that contain it. The
query of a rule is answered by intersecting and uniting postings, and only those
documents are searched with the expression itself. A rule without a mandatory trigram
scans the whole segment.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from re import _constants as op
from re import _parser as parser

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from panelkiln.llm.common import keyed, text_key

#: Alternatives of a piece of an expression that are spelled out before it is left to the scan.
_MOST = 64


@dataclass(frozen=True)
class Rule:
    """A kind of secret: an ASCII expression, and the least length of a group (0: the match) for it to count."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0
    any_case: bool = False

    def compiled(self) -> re.Pattern:
        return re.compile(self.pattern, re.ASCII | (re.IGNORECASE if self.any_case else 0))


#: The first three are fixed by contract, in the order in which kinds are listed.
RULES = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8, True),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 16),
    Rule("hex", r"[0-9a-f]+", 0, 32),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("google", r"AIza[0-9A-Za-z_-]{35}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
    Rule("pem", r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----"),
    Rule("slack", r"xox[abprs]-[0-9A-Za-z-]{10,}"),
    Rule("stripe", r"[rs]k_live_[0-9A-Za-z]{16,}"),
)

#: A query: ("and" | "or", parts), where a part is a query or a trigram; None asks for nothing.
Query = tuple | str | None


def _both(a: Query, b: Query) -> Query:
    if a is None or b is None:
        return a or b
    return a if a == b else ("and", (a, b))


def _of(word: str) -> Query:
    grams = dict.fromkeys(word[i : i + 3] for i in range(len(word) - 2))
    return ("and", tuple(grams)) if grams else None


def _any(words: set[str]) -> Query:
    """One of the words is there; nothing is known if one has no trigram."""
    queries = [_of(w) for w in sorted(words)]
    if not queries or None in queries:
        return None
    return queries[0] if len(queries) == 1 else ("or", tuple(queries))


def _exact(items) -> set[str] | None:
    """All strings that a sequence of parsed items can match, or None if too many."""
    out = {""}
    for kind, value in items:
        if kind is op.LITERAL:
            these = {chr(value)}
        elif kind is op.IN and all(k in (op.LITERAL, op.RANGE) for k, _ in value):
            width = sum(1 if k is op.LITERAL else v[1] - v[0] + 1 for k, v in value)
            if width > 8:
                return None
            these = {chr(c) for k, v in value for c in ([v] if k is op.LITERAL else range(v[0], v[1] + 1))}
        elif kind is op.SUBPATTERN and not value[1] and not value[2]:
            these = _exact(value[3])
        elif kind is op.BRANCH:
            parts = [_exact(p) for p in value[1]]
            these = None if None in parts else set().union(*parts)
        elif kind in (op.MAX_REPEAT, op.MIN_REPEAT) and value[1] <= 4:
            once = _exact(value[2])
            these = None
            if once is not None:
                these, run = set(), {""}
                for n in range(value[1] + 1):
                    these |= run if n >= value[0] else set()
                    run = {a + b for a in run for b in once} if len(run) * len(once) <= _MOST else None
                    if run is None:
                        return None
        else:
            return None
        if these is None or len(out) * len(these) > _MOST:
            return None
        out = {a + b for a in out for b in these}
    return out


def _query(items) -> Query:
    """What every match of a sequence contains: runs that can be spelled out, and what is mandatory inside the rest."""
    found: Query = None
    items, i = list(items), 0
    while i < len(items):
        j, words = i, {""}
        while j < len(items) and (more := _exact(items[i : j + 1])) is not None:
            j, words = j + 1, more
        if j > i:
            found = _both(found, _any(words))
            i = j
            continue
        kind, value = items[i]
        if kind is op.SUBPATTERN and not value[1] and not value[2]:
            found = _both(found, _query(value[3]))
        elif kind is op.BRANCH:
            parts = [_query(p) for p in value[1]]
            found = _both(found, None if None in parts else ("or", tuple(parts)))
        elif kind in (op.MAX_REPEAT, op.MIN_REPEAT) and value[0] > 0:
            found = _both(found, _query(value[2]))
        i += 1
    return found


def _fold(word: str) -> str:
    return "".join(c.lower() if c.isascii() else c for c in word)


def _folded(query: Query) -> Query:
    if isinstance(query, tuple):
        return query[0], tuple(_folded(q) for q in query[1])
    return _fold(query)


def trigram_query(rule: Rule) -> Query:
    """The Boolean query of trigrams, ASCII letters in lower case, that every document with a match meets."""
    flags = re.ASCII | (re.IGNORECASE if rule.any_case else 0)
    query = _query(parser.parse(rule.pattern, flags))
    return None if query is None else _folded(query)


def _grams(query: Query) -> set[str]:
    if query is None:
        return set()
    return {query} if isinstance(query, str) else set().union(*map(_grams, query[1]))


def _answer(query: Query, postings: dict[str, np.ndarray]) -> np.ndarray:
    """Numbers of the documents, ascending."""
    if isinstance(query, str):
        return postings[query]
    parts = [_answer(q, postings) for q in query[1]]
    if query[0] == "or":
        return np.unique(np.concatenate(parts))
    parts.sort(key=len)
    found = parts[0]
    for p in parts[1:]:
        found = np.intersect1d(found, p, assume_unique=True)
    return found


def _postings(folded: pa.Array, grams: set[str]) -> dict[str, np.ndarray]:
    return {g: np.flatnonzero(pc.match_substring(folded, g).to_numpy(zero_copy_only=False)) for g in grams}


def _matches(rule: Rule, pattern: re.Pattern, text: str) -> Iterator[tuple[int, int]]:
    for m in pattern.finditer(text):
        if len(m[rule.group]) >= rule.least:
            yield m.span()


_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("first", pa.int64()), ("stop", pa.int64())]))


def secret_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row per document: doc_id, text_key and ``spans``, an array of (kind, first, stop).

    Spans are whole matches in code points, ``stop`` exclusive, leftmost and not
    overlapping within a kind, by start and then by the order of the rules.
    Whole texts are searched. A null text is empty and has no spans; a null id
    stays null; repeated rows each get theirs; other columns play no part. An
    empty table gives an empty table.
    """
    queries = [trigram_query(r) for r in rules]
    grams = set().union(*map(_grams, queries))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        patterns = [r.compiled() for r in rules]
        for batch in batches:
            texts = pc.fill_null(batch.column("text"), "")
            postings = _postings(pc.ascii_lower(texts), grams)
            found: dict[int, list] = {}
            for rank, (rule, query, pattern) in enumerate(zip(rules, queries, patterns)):
                at = range(len(texts)) if query is None else _answer(query, postings).tolist()
                for i in at:
                    for start, stop in _matches(rule, pattern, texts[i].as_py()):
                        found.setdefault(i, []).append((start, rank, stop))
            spans = [
                [{"kind": rules[k].kind, "first": a, "stop": b} for a, k, b in sorted(found.get(i, ()))] for i in range(len(texts))
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_key"), pa.array(spans, _SPANS)], ["doc_id", "text_key", "spans"]
            )

    rows = keyed(docs, id_col, text_col).withColumn("text_key", text_key(F.col("text")))
    return rows.mapInArrow(scan, "doc_id long, text_key long, spans array<struct<kind: string, first: long, stop: long>>")


def mask(text: str | None, spans: list[tuple[int, int]], by: str = "[SECRET]") -> str | None:
    """The text with what the spans cover replaced, overlapping spans as one."""
    if text is None:
        return None
    out, at, covered = [], 0, 0
    for start, stop in sorted(spans):
        if start >= covered:
            out += [text[at:start], by]
        covered = max(covered, stop)
        at = covered
    return "".join(out) + text[at:]


def masked(docs: DataFrame, text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``docs`` with every secret in its text replaced; ``n_chars``, if there, is counted anew where a text changed."""
    columns = docs.columns
    queries = [trigram_query(r) for r in rules]
    grams = set().union(*map(_grams, queries))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        patterns = [r.compiled() for r in rules]
        for batch in batches:
            at = batch.schema.get_field_index(text_col)
            texts = pc.fill_null(batch.column(at), "")
            postings = _postings(pc.ascii_lower(texts), grams)
            found: dict[int, list] = {}
            for rule, query, pattern in zip(rules, queries, patterns):
                for i in range(len(texts)) if query is None else _answer(query, postings).tolist():
                    if spans := list(_matches(rule, pattern, texts[i].as_py())):
                        found.setdefault(i, []).extend(spans)
            arrays = list(batch.columns)
            if found:
                changed = batch.column(at).to_pylist()
                for i, spans in found.items():
                    changed[i] = mask(changed[i], spans)
                arrays[at] = pa.array(changed, batch.schema.field(at).type)
                if "n_chars" in columns:
                    k = columns.index("n_chars")
                    counts = arrays[k].to_pylist()
                    for i in found:
                        counts[i] = len(changed[i])
                    arrays[k] = pa.array(counts, batch.schema.field(k).type)
            yield pa.RecordBatch.from_arrays(arrays, schema=batch.schema)

    return docs.mapInArrow(scan, docs.schema)
