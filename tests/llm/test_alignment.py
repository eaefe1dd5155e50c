"""Cross-tokenizer alignment against whole texts encoded at once."""

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from helpers_llm import awkward, by_repr, frame
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from panelkiln.llm import alignment
from panelkiln.llm.alignment import Fragment

ODD = ["<|endoftext|>", "</s> <s>", "▁x", " ▁", "\x00", "\x1c y", "é" * 9, "日本語の文章。", "  ", "  z", "　", " \n ", "don't", "a  b", "<0x41>", "<unk>", "😀👍🏽", "x" * 90, "\r\n\t", "1234567", "̈", "﻿"]


def whole(text, a_model, b_model, a_bytes, b_bytes):
    """(A ids, B ids, groups, links) of a text, or None."""
    if not text:
        return None
    data = (" " + text).encode()
    a, b = a_model.encode(" " + text, add_special_tokens=False).ids, b_model.encode(text)
    if b"".join(a_bytes[i] for i in a) != data or b"".join(b_bytes[i] for i in b) != data:
        return None
    ends, at = {}, 0
    for i, t in enumerate(a):
        at += len(a_bytes[t])
        ends[at] = i
    groups, links, at, last_a, last_b = [], [], 0, 0, 0
    for j, t in enumerate(b):
        at += len(b_bytes[t])
        if at in ends:
            i = ends[at]
            groups.append(",".join(map(str, a[last_a : i + 1])) + "|" + ",".join(map(str, b[last_b : j + 1])))
            links.append((a[i], t))
            last_a, last_b = i + 1, j + 1
    return a, b, groups, links


@pytest.fixture(scope="module")
def models():
    a, b = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    a.encode_special_tokens = True
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    character = {b: chr(b) for b in printable}
    for i, byte in enumerate(b for b in range(256) if b not in printable):
        character[byte] = chr(256 + i)
    back = {c: b for b, c in character.items()}
    a_bytes = {i: bytes(back[c] for c in t) if all(c in back for c in t) else t.encode() for t, i in a.get_vocab().items()}
    b_bytes = {i: bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in range(b.get_piece_size())}
    return a, b, a_bytes, b_bytes


def brute(rows, models):
    found = [(r[0], whole(r[1], *models)) for r in rows]
    counts = Counter(link for _, w in found if w for link in w[3])
    most = {}
    for (_, b), n in counts.items():
        most[b] = max(most.get(b, 0), n)
    out = []
    for doc_id, w in found:
        if w is None:
            out.append((doc_id, 0, 0, 0, 0, 0, 0, ""))
            continue
        a, b, groups, links = w
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest()
        best = sum(counts[link] == most[link[1]] for link in links)
        out.append((doc_id, len(a), len(b), len(groups), len(links), best, sum(counts[link] for link in links), digest))
    return out


def odd_rows(seed):
    rng = random.Random(seed)
    rows = awkward(seed, n=40)
    for i in range(40):
        text = "".join(rng.choice([*ODD, "wort", " a", " The", "ab cd"]) + rng.choice(["", " ", " ", "  "]) for _ in range(rng.randint(1, 30)))
        rows.append((1000 + i, text, "s", None, len(text)))
    rows += [(2000 + i, t, None, None, len(t)) for i, t in enumerate([*ODD, " lead", "trail ", " ", "  two"])]
    return rows


@pytest.mark.parametrize("size", [37, 1 << 16])
def test_alignment(spark, models, size):
    rows = odd_rows(size)
    got = alignment.align(frame(spark, rows, clash=True), size=size)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert by_repr(tuple(r) for r in got.collect()) == by_repr(brute(rows, models))


def test_alignment_of_no_rows(spark):
    assert alignment.align(frame(spark, [(1, "x", "s", "l", 1)]).where("doc_id > 1")).collect() == []


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 3), min_size=1, max_size=40), st.lists(st.integers(1, 3), min_size=1, max_size=40), st.lists(st.integers(0, 120), max_size=6))
def test_fragments_of_any_byte_ranges_compose(a_lengths, b_lengths, cuts):
    """Ranges may end within ids and groups; any way to compose them gives the text's groups."""
    total = max(sum(a_lengths), sum(b_lengths))
    a_lengths, b_lengths = ([*x, total - sum(x)] if sum(x) < total else x for x in (a_lengths, b_lengths))
    a_ends, b_ends = np.cumsum(a_lengths), np.cumsum(b_lengths)
    a, b = np.arange(len(a_ends)), 100 + np.arange(len(b_ends))
    full = Fragment.of_range(a, a_ends, b, b_ends, 0, total)
    edges = [0, *sorted(c % (total + 1) for c in cuts), total]
    parts = [Fragment.of_range(a, a_ends, b, b_ends, s, e) for s, e in zip(edges, edges[1:])]
    left, right = Fragment.none(), Fragment.none()
    for p in parts:
        left = left + p
    for p in reversed(parts):
        right = p + right
    for f in (left, right, Fragment.unpacked(left.packed())):
        assert f.groups() == full.groups() and f.links().tolist() == full.links().tolist()
    seen = [f.prefix for f in [full]] + full.closed + [full.suffix]
    assert sum(len(x) for x, _ in seen) == len(a) and sum(len(y) for _, y in seen) == len(b) and not len(full.suffix[0])
