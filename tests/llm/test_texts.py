"""Quality rules, secrets, fingerprints, archives, packing, mixing and licenses against brute force."""

import base64
import hashlib
import math
import random
import re
import struct
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
import zstandard
from helpers_llm import awkward, by_repr, frame, sorted_rows, words
from pyspark.sql import functions as F

from panelkiln.llm import licenses, mixing, multiset, packing, quality, secrets, warc


def brute_measures(text):
    text = text or ""
    w = words(text)
    lines = [x for x in text.split("\n") if words(x)]
    windows, covered = Counter(zip(w, w[1:], w[2:])), set()
    for i in range(len(w) - 2):
        if windows[tuple(w[i : i + 3])] > 1:
            covered |= {i, i + 1, i + 2}
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered)


def normal(line):
    return re.sub("[0-9]", "0", " ".join(words("".join(c.lower() if "A" <= c <= "Z" else c for c in line))))


def brute_verdicts(rows, share, least):
    texts, held = defaultdict(set), defaultdict(set)
    for r in rows:
        texts[r[2]].add(r[1])
        for line in (r[1] or "").split("\n"):
            if words(line):
                held[r[2], normal(line)].add(r[1])
    for r in rows:
        m = brute_measures(r[1])
        gone = sum(
            len(words(x)) for x in (r[1] or "").split("\n") if len(held[r[2], normal(x)]) > max(least, share * len(texts[r[2]]))
        )
        failed = m[0] < 50 or 100 * m[4] > 50 * m[0]
        yield (r[0], *m, failed, gone, not failed and m[0] - gone >= 0.5 * m[0])


def lined(seed):
    rng = random.Random(seed)
    menu = ["Menu  12\thome about", "buy now 7", "read more # | news"]
    rows = awkward(seed, n=40)
    for i, r in enumerate(rows):
        own = [" ".join(f"w{rng.randrange(5000)}" for _ in range(12)) for _ in range(rng.randint(1, 9))]
        text = "\n".join([*own, *rng.sample(menu, rng.randint(0, 3))] + own[:1] * rng.randint(0, 1)) if r[1] and i % 4 else r[1]
        rows[i] = (r[0], text, "one" if i % 3 else r[2], r[3], r[4])
    rows.append((500, "\n".join(["menu 98 HOME about"] * 20), "one", None, None))
    return rows


def test_quality_rules(spark):
    rows = lined(1)
    want = by_repr(brute_verdicts(rows, 0.2, 3))
    assert sum(r[7] > 0 for r in want) > 10 and 5 < sum(r[-1] for r in want) < len(want)
    columns = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "n_line_words", "kept"]
    for clash in (False, True):
        assert sorted_rows(quality.judged(frame(spark, rows, clash), share=0.2, least=3), *columns) == want
    kept = quality.filtered(frame(spark, rows, True), share=0.2, least=3)
    assert kept.columns == frame(spark, rows, True).columns
    got = kept.collect()
    assert sorted(r.doc_id or -1 for r in got) == sorted(r[0] or -1 for r in want if r[-1])
    assert not any("menu" in r.text.lower() and r.source == "one" for r in got)
    assert quality.judged(frame(spark, [])).count() == quality.filtered(frame(spark, [])).count() == 0


def test_copies_do_not_count_against_a_document(spark):
    text = "\n".join(" ".join(f"w{i}_{j}" for j in range(10)) for i in range(8))
    rows = [(i, text, "s", None, None) for i in range(60)] + [(100 + i, text + f"\n{i} x", "t", None, None) for i in range(3)]
    assert quality.filtered(frame(spark, rows)).count() == 63


def brute_spans(text):
    found = []
    for rank, rule in enumerate(secrets.RULES):
        pattern = re.compile(rule.pattern, re.A | (re.I if rule.any_case else 0))
        found += [(m.start(), rank, m.end()) for m in pattern.finditer(text or "") if len(m[rule.group]) >= rule.least]
    return ",".join(f"{secrets.RULES[k].kind}:{a}:{b}" for a, k, b in sorted(found))


def secret_rows():
    rng = random.Random(8)
    bits = [
        "password=hunter2hunter2", 'Api_Key" : "abcdEFGH12345678"', "APIKEY=short", "token: ab", "ſecret=12345678", "AKIA" + "A1" * 8, "AKIAxx", "ab" * 16,
        "ab" * 15 + "a", "xABab" + "0f" * 17, "ghp_" + "aB3" * 12, "AIza" + "x" * 35, "eyJ" + "a" * 12 + ".eyJ" + "b" * 12 + "." + "c" * 12,
        "-----BEGIN RSA PRIVATE KEY-----", "-----BEGIN PRIVATE KEY-----", "xoxb-1234567890ab", "sk_live_" + "a1" * 9, "secret=token=passwd=abcdefgh", "é😀",
    ]
    rows = awkward(9)
    return [(r[0], None if r[1] is None else r[1] + " ".join(rng.choice(bits) for _ in range(rng.randint(0, 4))), *r[2:]) for r in rows]


def test_secret_spans(spark):
    rows = secret_rows()
    want = by_repr((r[0], brute_spans(r[1])) for r in rows)
    line = F.array_join(F.transform("spans", lambda s: F.concat_ws(":", s.kind, s.first, s.stop)), ",").alias("line")
    for clash in (False, True):
        assert sorted_rows(secrets.secret_spans(frame(spark, rows, clash)).select("doc_id", line), "doc_id", "line") == want
    assert secrets.secret_spans(frame(spark, [])).count() == 0
    masked = secrets.masked(frame(spark, rows, True))
    assert masked.columns == frame(spark, rows, True).columns
    for r in masked.collect():
        assert brute_spans(r.text) == "" and (r.text is None or "[SECRET]" not in r.text or r.n_chars == len(r.text))


def test_trigram_queries_are_met_by_every_match():
    for rule in secrets.RULES:
        query = secrets.trigram_query(rule)
        assert (query is None) == (rule.kind == "hex")
    grams = secrets._grams
    rule = lambda p: secrets.Rule("x", p)
    assert secrets.trigram_query(rule("a.*b")) is None
    assert secrets.trigram_query(rule("abcd|x")) is None
    assert grams(secrets.trigram_query(rule("abc(def|ghi)+x*"))) == {"abc", "bcd", "cde", "def", "bcg", "cgh", "ghi"} or grams(
        secrets.trigram_query(rule("abc(def|ghi)+x*"))
    ) == {"abc", "def", "ghi"}
    assert secrets.mask("abcdef", [(1, 3), (2, 4)]) == "a[SECRET]ef"


def brute_paragraphs(text):
    return [p.strip() for line in text.split("\n") for p in re.split(r"(?<=[.!?])[ \t]+", line) if p.strip()]


def brute_vector(parts):
    total = [0] * (multiset.UNIFORM + multiset.SIGNS)
    for p in parts:
        digest = hashlib.shake_128(p.encode()).digest(8 * multiset.UNIFORM + multiset.SIGNS // 8)
        for i in range(multiset.UNIFORM):
            total[i] += int.from_bytes(digest[8 * i : 8 * i + 8], "little")
        for i in range(multiset.SIGNS):
            byte = digest[8 * multiset.UNIFORM + i // 8]
            total[multiset.UNIFORM + i] += 1 if byte >> (7 - i % 8) & 1 else -1
    uniform, signs = total[: multiset.UNIFORM], total[multiset.UNIFORM :]
    return b"".join([*(struct.pack("<Q", x % 2**64) for x in uniform), *(struct.pack("<I", x % 2**32) for x in signs)]).hex()


def brute_cosine(a, b):
    a, b = Counter(a), Counter(b)
    both = math.sqrt(sum(n * n for n in a.values()) * sum(n * n for n in b.values()))
    return sum(n * b[p] for p, n in a.items()) / both if both else 0.0


def test_many_equal_paragraphs_are_told_apart():
    few, many, most = (multiset.vector(["line"] * n) for n in (30_000, 40_000, 65_536))
    assert len({multiset.as_text(v) for v in (few, many, most, multiset.vector([]))}) == 4
    assert multiset.likeness(few, many) == pytest.approx(1.0) and multiset.likeness(most, multiset.vector([])) == 0.0


def test_multiset_hash():
    a, b = ["one.", "two", "two", "é"], ["three", "one."]
    assert multiset.as_text(multiset.vector(a)) == brute_vector(a)
    assert multiset.as_text(multiset.vector(a + b)) == multiset.as_text(multiset.vector(b[::-1] + a[::-1]))
    whole = multiset.vector(a + b)
    assert (multiset.edited(whole, b, ["new"]) == multiset.vector([*a, "new"])).all()
    assert multiset.likeness(whole, whole) == 1.0 and multiset.likeness(multiset.vector([]), whole) == 0.0
    many = [str(i) for i in range(400)]
    near = multiset.likeness(multiset.vector(many), multiset.vector(many[:300] + [f"x{i}" for i in range(100)]))
    assert 0.55 < near < 0.95 and multiset.likeness(multiset.vector(many[:200]), multiset.vector(many[200:])) < 0.3


@pytest.mark.parametrize("no_ids", [False, True])
def test_edit_study(spark, no_ids):
    rows = [(None if no_ids else r[0], *r[1:]) for r in awkward(10)]
    ordered = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] or ""))
    want = []
    for r, following in zip(ordered, ordered[1:] + ordered[:1]):
        text, after = r[1] or "", following[1] or ""
        quarter = len(text) // 4
        changed = text[: len(text) - quarter] + after[:quarter]
        marks = [multiset.as_text(multiset.vector(multiset.paragraphs(t))) for t in (text, changed)]
        want.append((r[0], len(text), changed, *marks))
    got = multiset.edit_study(frame(spark, rows, True))
    columns = ["doc_id", "n_chars", "edited_text", "fingerprint", "edited_fingerprint"]
    assert sorted_rows(got, *columns) == by_repr(want)
    likenesses = {}
    for r in got.collect():
        likenesses.setdefault((r.doc_id, r.edited_text), []).append((r.near_edited, r.near_next))
    for r, following in zip(ordered, ordered[1:] + ordered[:1]):
        text, after = r[1] or "", following[1] or ""
        quarter = len(text) // 4
        changed = text[: len(text) - quarter] + after[:quarter]
        parts = [brute_paragraphs(t) for t in (text, changed, after)]
        want = [1.0 if Counter(parts[0]) == Counter(p) else brute_cosine(parts[0], p) for p in parts[1:]]
        assert any(max(abs(x - y) for x, y in zip(want, near)) < 0.3 for near in likenesses[r[0], changed])  # the estimate's deviation is 1 / 16
    assert got.where("fingerprint = edited_fingerprint and near_edited <> 1").count() == 0
    assert multiset.edit_study(frame(spark, [])).count() == multiset.fingerprints(frame(spark, [])).count() == 0


def test_archives(spark, tmp_path):
    rng = random.Random(11)
    rows = [(i, f"http://x/{i}", "".join(rng.choice(["<p>", "wort ", "é", "\n", "\0"]) for _ in range(rng.randint(0, 300)))) for i in range(300)]
    rows += [(300 + i, "u\nv", rows[i % 5][2]) for i in range(40)]
    rows += [(None, None, rows[0][2]), (400, None, None), (401, "z", ""), (402, "w", "é" * 400_000), (402, "w", "é" * 400_000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit("other")).repartition(4)
    for least in (0, 200):
        folder = str(tmp_path / f"a{least}")
        warc.write_archives(pages, folder, least)
        got = warc.read_archives(spark, folder).collect()
        last = {}
        for page, _, html in rows:
            last[html or ""] = max(last.get(html or "", -1), -1 if page is None else page)
        want = []
        for page, _, html in rows:
            payload = (html or "").encode()
            response = page == last[html or ""] or len(payload) < least
            digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
            want.append((page, len(payload), digest, "response" if response else "revisit", None if response else last[html or ""], payload if response else None))
        assert by_repr((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to, r.payload and bytes(r.payload) or (b"" if r.payload is not None else None)) for r in got) == by_repr(want)
    first = max((tmp_path / "a0").glob("part-*"), key=lambda p: p.stat().st_size).read_bytes()
    assert struct.unpack_from("<I", first)[0] == warc.DICTIONARY_FRAME
    with pytest.raises((ValueError, zstandard.ZstdError)):
        list(warc.read_frames(first[: len(first) // 2]))
    starts = [0, 5, 8, 20, 100, 1000, len(first) // 10, len(first) // 5, len(first) // 3, len(first) - 1, len(first) - 9, len(first) - 10, len(first) - 17, len(first) - 18]
    for stop in starts + random.Random(1).sample(range(len(first)), 60):
        with pytest.raises((ValueError, zstandard.ZstdError)):
            list(warc.read_frames(first[:stop]))
    empty = str(tmp_path / "empty")
    warc.write_archives(pages.limit(0), empty)
    assert warc.read_archives(spark, empty).count() == 0


def _archives(rows):
    """Files as Spark's writer makes them of rows, and their records."""
    return b"".join(r + b"\n" for r in rows)


def test_every_cut_of_an_archive_is_an_error():
    records = [f"record {i} ".encode() * (i % 40) + b"\n" for i in range(60)]
    for some in (records, [b"x"], []):
        archive = _archives(warc.rows_of(iter(some)))
        assert list(warc.read_frames(archive)) == some
        for stop in range(len(archive)):
            with pytest.raises((ValueError, zstandard.ZstdError)):
                list(warc.read_frames(archive[:stop]))
    press = zstandard.ZstdCompressor()
    foreign = b"".join(press.compress(r) for r in records)
    assert list(warc.read_frames(foreign, counted=False)) == records
    with pytest.raises(ValueError):
        list(warc.read_frames(foreign))


def test_lost_records_are_an_error():
    rows = list(warc.rows_of(iter([bytes([i]) * 900 for i in range(40)]), row_bytes=100))
    assert len(list(warc.read_frames(_archives(rows)))) == 40
    for k in range(1, len(rows) - 1):
        with pytest.raises(ValueError):
            list(warc.read_frames(_archives(rows[:k] + rows[k + 1 :])))


@pytest.mark.parametrize("n", [0, 1, 2, 3, 50, 997])
def test_archives_roll(n):
    rng = random.Random(n)
    records = [rng.randbytes(rng.randint(1, 200)) for _ in range(n)]
    rows = list(warc.rows_of(iter(records), rows=5, row_bytes=300))
    files = [rows[i : i + 5] for i in range(0, len(rows), 5)]
    assert all(len(f) == 5 for f in files[:-1])
    assert [r for f in files for r in warc.read_frames(_archives(f))] == records


def test_rolled_archives_through_spark(spark, tmp_path):
    rows = [(i, None, f"page {i} " * (i % 90)) for i in range(700)]
    folder = str(tmp_path / "rolled")
    warc.write_archives(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(2), folder, rows=4, row_bytes=500)
    assert len(list((tmp_path / "rolled").glob("part-*"))) > 8
    got = warc.read_archives(spark, folder).where("record_type = 'response'").collect()
    assert len({r.payload_digest for r in got}) == len(got) == len({r[2] for r in rows})


def reference_ids(text):
    from tokenizers import Tokenizer

    tokenizer = reference_ids.__dict__.setdefault("t", Tokenizer.from_file(packing.tokenizer_path()))
    return tokenizer.encode(text or "", add_special_tokens=False).ids + [2]


def test_word_ids_are_the_tokenizers():
    odd = ["It's", "don't.", "ΑΣ.", "…", "x-.", "..,", "ſ", "3.14,", "日本語。", "<|STARTOFTEXT|>", "<|endoftext|>a", "\x1c", "a\x1cb", "\xa0", "　z", "İ", "A'", "🙂.", "aΣ"]
    rng, known = random.Random(12), packing.WordIds(packing.tokenizer_path())
    texts = ["".join(rng.choice(odd) + rng.choice(["", " ", "\n", "\xa0"]) for _ in range(rng.randint(0, 9))) for _ in range(1500)]
    for text, got in zip(texts, known.of([t.encode() for t in texts])):
        assert np.frombuffer(got, "<u4").tolist() == reference_ids(text)[:-1]


def test_word_ids_of_plain_and_other_words():
    letters = [*map(chr, range(33, 127)), *map(chr, range(0xA1, 0x180)), *"АЙйяёЁΣς一龥がﬁ\x7f\x01\u0301", "'s", "'re", "'LL", "é", "ß", "µ", "×"]
    rng, known = random.Random(3), packing.WordIds(packing.tokenizer_path())
    texts = ["".join(rng.choice(letters) + " " * (rng.random() < 0.2) for _ in range(rng.randint(0, 30))) for _ in range(3000)]
    for _ in range(2):
        for text, got in zip(texts, known.of([t.encode() for t in texts])):
            assert got == known.plain(text)


def test_long_words_and_very_many_are_not_remembered(monkeypatch):
    rng, known = random.Random(4), packing.WordIds(packing.tokenizer_path())
    long = ["".join(rng.choices("abcdefghij", k=2000)) for _ in range(500)]
    known.of([b"warm up"])
    tracemalloc.start()
    for word in long:
        assert len(known.of([word.encode()])) == 1
    kept = tracemalloc.get_traced_memory()[0]
    tracemalloc.stop()
    assert kept < 500_000
    monkeypatch.setattr(packing, "REMEMBERED", 100)
    texts = [" ".join(f"{rng.choice('ab')}{rng.choice('cd')}{rng.randint(0, 400)}" for _ in range(20)) for _ in range(300)]
    for text in texts:
        assert known.of([text.encode()]) == [known.plain(text)]
        assert len(known.recent) + len(known.older) <= 2 * (100 + 20)


def test_open_pieces_do_not_hold_their_documents(spark, monkeypatch):
    held = []
    add = packing.Packer.add
    monkeypatch.setattr(packing.Packer, "add", lambda self, piece: (held.append(len(piece.ids.obj)), add(self, piece)))
    monkeypatch.setattr(packing, "TaskContext", type("Context", (), {"get": classmethod(lambda c: c), "partitionId": classmethod(lambda c: 0)}))
    docs = frame(spark, [])
    monkeypatch.setattr(type(docs), "mapInArrow", lambda self, scan, schema: scan)
    batch = pa.RecordBatch.from_pydict({"doc_id": [1, 2], "text": ["ab " * 90_000, None], "loss_from": [0, 0]})
    batches = list(packing.pack(docs)(iter([batch])))
    assert sum(pc.sum(b["length"]).as_py() for b in batches) == 90_002
    assert max(held) <= 4 * 4096
    assert max(b.nbytes for b in batches) < 2 * packing.OUT


@pytest.mark.parametrize("limits", [{}, {"max_tokens": 64, "max_segments": 3}, {"max_tokens": 100, "max_segments": 5, "max_loss_tokens": 17}])
def test_packing(spark, limits):
    rows = awkward(13, n=80)
    df = frame(spark, rows, True).withColumn("loss_from", F.when(F.col("doc_id") % 2 == 0, F.col("doc_id") % 9))
    got = [r.asDict() for r in packing.pack(df, **limits).collect()]
    most = {"max_tokens": 4096, "max_segments": 256, "max_loss_tokens": None, **limits}
    wanted, pieces = Counter(), defaultdict(list)
    for r in rows:
        wanted[r[0], tuple(reference_ids(r[1]))] += 1
    by_sequence = defaultdict(list)
    for p in got:
        by_sequence[p["sequence_id"]].append(p)
        pieces[p["doc_id"], p["doc_tokens"]].append(p)
    for own in by_sequence.values():
        own.sort(key=lambda p: p["offset"])
        total = sum(p["length"] for p in own)
        assert [p["offset"] for p in own] == [sum(q["length"] for q in own[:i]) for i in range(len(own))]
        assert total == most["max_tokens"] or total < most["max_tokens"] and total & (total - 1) == 0
        assert len(own) <= most["max_segments"] and sum(p["loss_tokens"] for p in own) <= (most["max_loss_tokens"] or most["max_tokens"])
    # Every id of every row is in one piece: of each (id, length) as many copies of each place as there are rows.
    for (doc_id, n), own in pieces.items():
        texts = [list(t) for (d, t), c in wanted.items() for _ in range(c) if d == doc_id and len(t) == n]
        assert sum(p["length"] for p in own) == n * len(texts)
        cover = Counter((p["start"] + j, x) for p in own for j, x in enumerate(np.frombuffer(p["ids"], "<u4").tolist()))
        assert cover == Counter((j, x) for t in texts for j, x in enumerate(t))
    assert sum(p["length"] for p in got) == sum(len(t) * c for (_, t), c in wanted.items())
    assert packing.pack(frame(spark, [])).count() == 0


def brute_targets(sizes):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: float(i % 3 + 1) for i, s in enumerate(names)}
    total, capped = float(sum(sizes.values())), set()
    while True:
        rest = total - sum(3.0 * sizes[s] for s in capped)
        scale = sum(weight[s] for s in names if s not in capped)
        target = {s: 3.0 * sizes[s] if s in capped else rest * weight[s] / scale for s in names}
        over = {s for s in names if s not in capped and target[s] > 3.0 * sizes[s] + 1e-9}
        if not over:
            return target
        capped |= over


def test_mixing(spark):
    rows = [(r[0], r[1], ["a", "é", None, "b", "😀", "ﬀ"][i % 17 % 6], r[3], r[4]) for i, r in enumerate(awkward(14, n=150))]
    weights = spark.createDataFrame([(i, float(i % 3)) for i in range(0, 150, 2)], "doc_id long, weight double")
    df = frame(spark, rows, True)
    got = mixing.mix(df, weights).collect()
    size = Counter()
    for r in rows:
        size[r[2]] += len(words(r[1]))
    want = brute_targets(size)
    taken = Counter()
    for r in got:
        assert r.source_size == size[r.source] and abs(r.target - want[r.source]) < 1e-6
        assert 0 <= r.taken <= 3 * r.size
        taken[r.source] += r.taken
    assert all(abs(taken[s] - want[s]) <= 1 for s in size)
    assert by_repr((r.doc_id, r.size) for r in got) == by_repr((r[0], len(words(r[1]))) for r in rows)
    again = mixing.mix(df.repartition(5), weights).collect()
    assert by_repr(tuple(r) for r in again) == by_repr(tuple(r) for r in got)
    mixed = mixing.mixed_documents(df, weights)
    assert mixed.columns == df.columns
    total = Counter()
    for r in mixed.collect():
        total[r.source] += len(words(r.text))
    assert total == +taken
    assert mixing.mix(frame(spark, [])).count() == mixing.mixed_documents(frame(spark, [])).count() == 0


def test_heavier_documents_come_first_more_often(spark):
    rows = [(i, f"text {i}", "a", None, None) for i in range(1500)] + [(9000, "w " * 30000, "b", None, None)]
    weights = spark.createDataFrame([(i, 4.0) for i in range(500)], "doc_id long, weight double")
    got = mixing.mix(frame(spark, rows), weights, cycle=(1.0, 20.0)).where("source = 'a'").collect()
    heavy = [r.taken for r in got if r.doc_id < 500]
    light = [r.taken for r in got if r.doc_id >= 500]
    assert 0 < sum(light) and sum(heavy) / len(heavy) > 1.5 * sum(light) / len(light)


def brute_licenses(rows):
    split = lambda t: re.findall(r"[^\W_]+", (t or "").lower())
    shingles = lambda w: [" ".join(w[i : i + 5]) for i in range(max(1, len(w) - 4))] if w else []
    found = defaultdict(dict)
    for r in rows:
        own = shingles(split(r[1]))
        for name, text in licenses.TEMPLATES:
            wanted = set(shingles(split(text)))
            step = -(-len(wanted) // 2)
            for start in range(0, len(own), step):
                share = len(wanted & set(own[start : start + len(wanted) + step])) / len(wanted)
                if share >= 0.8:
                    key = (r[0], r[1], name)
                    found[key][len(wanted), start] = max(share, found[key].get((len(wanted), start), 0))
    return by_repr((d, n, max(w.values()), min(s for _, s in w), len(w)) for (d, _, n), w in found.items())


def test_licenses(spark):
    rng, rows = random.Random(15), awkward(16)
    for i, r in enumerate(rows):
        if r[1] is not None and i % 3 == 0:
            name, notice = rng.choice(licenses.TEMPLATES)
            notice = notice.upper() if i % 2 else notice.replace(" ", "\n ")
            if len(notice) > 150:
                notice = " ".join(w for w in notice.split() if rng.random() > 0.02)
            rows[i] = (r[0], r[1] + " filler words " * rng.randint(0, 9) + notice + " end" * rng.randint(0, 3), *r[2:])
    want = brute_licenses(rows)
    assert len(want) > 10
    for clash in (False, True):
        got = licenses.scan(frame(spark, rows, clash))
        assert sorted_rows(got, "doc_id", "license", "containment", "first_shingle", "n_windows") == want
    assert licenses.scan(frame(spark, [])).count() == 0
    none = spark.createDataFrame([("x", ""), ("y", None)], "license string, text string")
    assert licenses.scan(frame(spark, rows), none).count() == 0
    assert zlib.crc32(b"") == 0
