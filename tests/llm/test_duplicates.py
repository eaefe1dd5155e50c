"""SimHash classes, repeated word windows and repeated byte strings against brute force."""

import itertools
import random
import re

import pytest
import xxhash
from helpers_llm import awkward, by_repr, frame, sorted_rows, words
from pyspark.sql import functions as F

import corpus_pipeline
from panelkiln.llm import debruijn, minhash, simhash, suffixes
from panelkiln.llm.components import components


def brute_fingerprint(text, n=3):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = words(lower)
    if not w:
        return 0
    grams = [" ".join(w[i : i + n]) for i in range(len(w) - n + 1)] or [" ".join(w)]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def least_reachable(nodes, linked):
    parent = {x: x for x in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(sorted(parent), 2):
        if linked(a, b):
            a, b = find(a), find(b)
            parent[max(a, b)] = min(a, b)
    return {x: find(x) for x in parent}


def test_simhash_classes(spark):
    rows = awkward(1, vocabulary=[f"w{i}" for i in range(200)])
    marks = [brute_fingerprint(r[1]) for r in rows]
    group = least_reachable(set(marks), lambda a, b: (a ^ b).bit_count() <= 2)
    first = {}
    for r, m in zip(rows, marks):
        if r[0] is not None:
            first[group[m]] = min(first.get(group[m], r[0]), r[0])
    want = by_repr((r[0], f"{m:016x}", first.get(group[m])) for r, m in zip(rows, marks))
    for clash in (False, True):
        got = simhash.near_duplicates(frame(spark, rows, clash))
        assert sorted_rows(got, "doc_id", "fingerprint", "component_id") == want
    assert simhash.near_duplicates(frame(spark, [])).count() == 0


@pytest.mark.parametrize("limit", [1, 4, 64])
def test_links_find_every_class_whatever_the_bucket_limit(spark, limit):
    rng = random.Random(limit)
    marks = set()
    for base in [rng.getrandbits(64) for _ in range(12)]:
        for _ in range(25):
            x = base
            for _ in range(rng.randint(0, 3)):
                x ^= 1 << rng.randrange(64)
            marks.add(x)
    signed = [x - (1 << 64) if x >> 63 else x for x in marks]
    want = least_reachable(signed, lambda a, b: ((a ^ b) & (2**64 - 1)).bit_count() <= 2)
    found = components(simhash.links(spark.createDataFrame([(x,) for x in signed], "fingerprint long"), limit))
    roots = {r.node: r.root for r in found.collect()}
    assert {x: roots.get(x, x) for x in signed} == want


def test_components_of_a_long_path_and_a_star(spark):
    n = 300
    edges = [(i, i + 1) for i in range(n)] + [(5000 + i, 9999) for i in range(n)] + [(1, 1), (None, 3), (0, 1)]
    random.Random(2).shuffle(edges)
    found = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {**{i: 0 for i in range(1, n + 1)}, **{5000 + i: 5000 for i in range(1, n)}, 9999: 5000}


def brute_words(rows, k):
    first = {}
    for r in rows:
        w = words(r[1])
        for i in range(len(w) - k + 1) if r[0] is not None else ():
            first[tuple(w[i : i + k])] = min(first.get(tuple(w[i : i + k]), r[0]), r[0])
    for r in rows:
        w, gone = words(r[1]), set()
        for i in range(len(w) - k + 1) if r[0] is not None else ():
            if first[tuple(w[i : i + k])] < r[0]:
                gone.update(range(i, i + k))
        yield r[0], len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)


@pytest.mark.parametrize(("k", "gather"), [(3, 10**6), (13, 50)])
def test_repeated_windows_of_words(spark, k, gather, monkeypatch):
    monkeypatch.setattr(debruijn, "GATHER", gather)
    rows = awkward(3, vocabulary=["a", "b", "é"], most=90)
    for clash in (False, True):
        got = debruijn.without_repeats(frame(spark, rows, clash), k=k)
        assert sorted_rows(got, "doc_id", "n_words", "n_removed", "kept_text") == by_repr(brute_words(rows, k))
    assert debruijn.without_repeats(frame(spark, [])).count() == 0


def test_edges_settled_in_one_task_are_those_that_meet(spark):
    rng = random.Random(4)
    docs = [(i, 0, debruijn.word_hashes([rng.choice([b"a", b"b"]) for _ in range(60)])) for i in range(30)]
    together = list(debruijn._edges(docs, 8, 4))
    apart = [row for d in docs for row in debruijn._edges([d], 8, 4)]

    def starts(sent):
        found = [row for p in range(4) for row in debruijn._meet([d for q, kind, d in sent if q == p and kind == 0], 4)]
        found += [row for row in sent if row[1] == 1]
        walks = debruijn._compact([data for _, _, data in found])
        return {(i, s + j) for i, s, n in zip(walks[0].tolist(), walks[2].tolist(), walks[3].tolist()) for j in range(n)}

    assert starts(together) == starts(apart) != set()


def brute_bytes(rows, length):
    count = {}
    texts = [(r[1] or "").encode() for r in rows]
    for t in texts:
        for i in range(len(t) - length + 1):
            count[t[i : i + length]] = count.get(t[i : i + length], 0) + 1
    for r, t in zip(rows, texts):
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if count[t[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        kept = bytes(x for x, g in zip(t, gone) if not g)
        yield r[0], len(t), bytearray(kept), len(re.findall(b"\1+", bytes(gone)))


@pytest.mark.parametrize("gather", [suffixes.GATHER, 700])
def test_repeated_byte_strings(spark, gather, monkeypatch):
    monkeypatch.setattr(suffixes, "GATHER", gather)
    rng = random.Random(5)
    passages = ["".join(rng.choice("abcé ") for _ in range(700)) for _ in range(4)]
    rows = awkward(6, n=30)
    for i, r in enumerate(rows):
        text = r[1]
        for _ in range(rng.randint(0, 4)):
            at = rng.randint(0, 600)
            text = (text or "") + rng.choice(passages)[at : at + rng.randint(0, 400)] + "".join(rng.choice("xyz") for _ in range(60))
        rows[i] = (r[0], text, *r[2:])
    rows += [(100, "a" * 500, None, None, None), (101, "ab" * 150, None, None, None), (102, "q" * 199, None, None, None), (103, "r" * 201, None, None, None)]
    got = suffixes.without_repeats(frame(spark, rows, True)).withColumn("n_spans", F.size("spans"))
    want = by_repr(brute_bytes(rows, 200))
    assert sorted_rows(got, "doc_id", "n_bytes", "kept", "n_spans") == by_repr((a, b, bytes(c), d) for a, b, c, d in want)
    assert suffixes.without_repeats(frame(spark, [])).count() == 0


def test_anchors_of_a_text_longer_than_places_can_say(monkeypatch):
    monkeypatch.setattr(suffixes, "GATHER", 700)
    monkeypatch.setattr(suffixes, "_PLACE", 11)
    rng = random.Random(10)
    text = bytes(rng.randrange(256) for _ in range(5000))
    held = suffixes.Segments(200)
    parts = []
    for key, own in (((0, 0), b"short" * 60), ((1, 0), text)):
        for segments in held.add(key, own):
            assert segments.size <= 2 * 700 + 199
            parts.append((list(segments.keys), list(segments.bases), segments.anchors()))
    if held.texts:
        parts.append((list(held.keys), list(held.bases), held.anchors()))
    starts = set()
    for keys, bases, (data, segment, at, start, count, hashes) in parts:
        assert (suffixes.rolling(data, suffixes.GRAM)[at] == hashes).all()
        assert ((start <= at) & (at < start + count + 200)).all()
        raw = data.tobytes()
        for j, s, n in zip(segment.tolist(), start.tolist(), count.tolist()):
            if keys[j] == (1, 0):
                first = text.find(raw[s : s + n + 199])
                assert first >= 0
                starts.update(range(first, first + n))
    assert starts == set(range(5000 - 199))


def test_levels_stay_logarithmic_and_miss_no_match():
    import numpy as np

    rng = np.random.default_rng(7)
    family, ones, others, seen = suffixes.Family(), [], [], []
    for i in range(100):
        marks = rng.integers(0, 4000, 50).astype(np.uint64)
        a, b = family.add(marks, np.arange(50) + 50 * i)
        ones.append(a)
        others.append(b)
        seen.append(marks)
        assert len(family.levels) <= 12
    seen, hit = np.concatenate(seen), np.zeros(5000, bool)
    hit[np.concatenate(ones)], hit[np.concatenate(others)] = True, True
    values, counts = np.unique(seen, return_counts=True)
    assert (hit == np.isin(seen, values[counts > 1])).all()


def brute_likeness(a, b, n=5):
    sets = []
    for text in (a, b):
        w = words("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
        sets.append({tuple(w[i : i + n]) for i in range(len(w) - n + 1)} or {tuple(w)})
    return len(sets[0] & sets[1]) / len(sets[0] | sets[1])


def near_texts(seed, groups, copies, most):
    """Texts of 60 words and copies of them with some words changed: likeness on both sides of 0.8."""
    rng = random.Random(seed)
    for _ in range(groups):
        base = [f"w{rng.randrange(400)}" for _ in range(60)]
        for _ in range(copies):
            own = list(base)
            for _ in range(rng.randint(0, most)):
                own[rng.randrange(60)] = f"x{rng.randrange(10**6)}"
            yield " ".join(own)


def groups_of(rows, group):
    found = {}
    for (doc_id, *_), g in zip(rows, group):
        found.setdefault(g, []).append(doc_id)
    return by_repr(by_repr(x) for x in found.values())


def got_groups(got):
    found = {}
    for r in got.collect():
        found.setdefault(r.group, []).append(r.doc_id)
    return by_repr(by_repr(x) for x in found.values())


@pytest.mark.parametrize(("groups", "copies", "exact"), [(30, 4, False), (30, 4, True), (3, 40, True)])
def test_near_copies_are_those_of_exact_likeness(spark, groups, copies, exact):
    """Awkward rows too: nulls, texts without words, repeated rows, rows without ids, a very long text."""
    texts = list(near_texts(8, groups, copies, 3))
    rows = [*awkward(9), *((1000 + i, t, "s", "en", len(t)) for i, t in enumerate(texts))]
    group = least_reachable(range(len(rows)), lambda a, b: brute_likeness(rows[a][1], rows[b][1]) >= 0.8)
    want = groups_of(rows, group.values())
    assert got_groups(minhash.near_copies(frame(spark, rows, True), exact=exact)) == want
    assert groups < len({g for r, g in zip(rows, group.values()) if (r[0] or 0) >= 1000}) < groups * copies
    assert minhash.near_copies(frame(spark, [])).count() == 0


def test_leaders_find_most_links_and_no_others(spark):
    """Groups of many copies whose likeness to each other is about 0.8: some pairs link, many don't."""
    rows = [(i, t, "s", "en", None) for i, t in enumerate(near_texts(3, 5, 60, 2))]
    group = least_reachable(range(len(rows)), lambda a, b: brute_likeness(rows[a][1], rows[b][1]) >= 0.8)
    got = {r.doc_id: r.group for r in minhash.near_copies(frame(spark, rows)).collect()}
    together = {}
    for doc_id, g in got.items():
        together.setdefault(g, set()).add(group[doc_id])
    assert all(len(g) == 1 for g in together.values())  # none that no links connect
    assert len(together) <= 1.1 * len(set(group.values()))


def test_pipeline_loses_no_link_that_leaders_miss(spark):
    """Pairs of likeness 0.83 whose bands hold a hundred texts of likeness 0.77 and less, so that few of a band's nodes are its leaders."""
    base, rows = [f"w{i}" for i in range(120)], []
    for group, places in enumerate(itertools.combinations(range(10, 118, 9), 2)):
        for copy in range(2):
            own = list(base)
            for p in places:
                own[p] = f"x{group}y{copy}z{p}"
            rows.append((2 * group + copy, " ".join(own), "s", "en", None))
    assert brute_likeness(rows[0][1], rows[1][1]) > 0.8 > brute_likeness(rows[0][1], rows[2][1])
    kept = corpus_pipeline.simhash_dedup(spark, frame(spark, rows), "")
    assert sorted(r.doc_id for r in kept.collect()) == list(range(0, len(rows), 2))


@pytest.mark.parametrize("meetings", [50, 10**6])
def test_all_pairs_that_may_link_meet_whatever_a_task_looks_at(spark, meetings, monkeypatch):
    monkeypatch.setattr(minhash, "MEETINGS", meetings)
    entries = [(key, node, node % 7 if node > 20 else 3) for key in (1, 2) for node in range(40)]
    nodes = spark.createDataFrame([(i, 10, 0, -1 if i == 39 else 0) for i in range(40)], "node long, n long, bits0 long, bits1 long")
    pairs = minhash._all_pairs(spark.createDataFrame(entries, "key long, node long, root long"), nodes, 0.8)
    root = {node: r for _, node, r in entries}
    want = {(a, b) for a, b in itertools.combinations(range(39), 2) if root[a] != root[b]}  # the bits of 39 are unlike
    got = [tuple(sorted((r.a, r.b))) for r in pairs.collect()]
    assert set(got) == want and len(got) == 2 * len(want)


@pytest.mark.parametrize("classes", [None, 3])
def test_links_between_classes_pass_by_what_classes_have_in_common(spark, classes):
    """Every link that shares a band leaves the join, once, however a node's shingles are cut into batches."""
    rows = [*awkward(12), *((1000 + i, t, "s", "en", None) for i, t in enumerate(near_texts(13, 6, 12, 3)))]
    marks = minhash._marks(frame(spark, rows), "doc_id", "text", minhash.SHINGLE).where("doc_id >= 1000").dropDuplicates(["node"]).localCheckpoint()
    nodes = {r.node: r for r in marks.collect()}
    text = {n: rows[[x[0] for x in rows].index(r.doc_id)][1] for n, r in nodes.items()}
    root = {n: n if classes is None else r.doc_id % classes for n, r in nodes.items()}
    entries = spark.createDataFrame([(k, n, root[n]) for n, r in nodes.items() for k in r.bands], "key long, node long, root long")
    texts, scratch = spark.createDataFrame(list(text.items()), "node long, text string"), minhash.Scratch(spark)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "17")
    try:
        common = scratch.stored(minhash._common(entries, texts, minhash.SHINGLE, 0.8, scratch))
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    got = [tuple(sorted((r.a, r.b))) for r in minhash._all_pairs(entries, marks, 0.8, common).collect()]
    met = [(a, b) for a, b in itertools.combinations(sorted(nodes), 2) if root[a] != root[b] and set(nodes[a].bands) & set(nodes[b].bands)]
    links = {(a, b) for a, b in met if brute_likeness(text[a], text[b]) >= 0.8}
    assert links and links <= set(got) <= set(met) and len(got) == len(set(got)) < len(met)
    sets = {n: set(minhash.shingles(t.encode()).tolist()) for n, t in text.items()}
    shared = {n: sum(any(h in sets[m] for m in nodes if root[m] != root[n]) for h in sets[n]) for n in nodes}
    assert {r.node: r.common for r in common.collect()} == {n: c for n, c in shared.items() if c >= 0.8 * len(sets[n])}
    scratch.clear()


def test_pairs_that_are_nearly_alike_do_not_leave_the_join(spark, monkeypatch):
    """Texts of one base with two words of their own each: likeness 0.71 to nearly all others, links to few."""
    rng, base, rows = random.Random(14), [f"w{i}" for i in range(120)], []
    for i in range(150):
        own = list(base)
        for p in rng.sample(range(120), 2):
            own[p] = f"x{i}y{p}"
        rows.append((i, " ".join(own), "s", "en", None))
    group = least_reachable(range(len(rows)), lambda a, b: brute_likeness(rows[a][1], rows[b][1]) >= 0.8)
    given, all_pairs = [], minhash._all_pairs

    def counted(*tables):
        pairs = all_pairs(*tables)
        given.append(pairs.count())
        return pairs

    monkeypatch.setattr(minhash, "_all_pairs", counted)
    assert got_groups(minhash.near_copies(frame(spark, rows))) == groups_of(rows, group.values())
    assert len(given) == 1 and given[0] < 11_175 / 4  # of all pairs


def test_pairs_with_leaders_grow_with_the_entries(spark):
    for m in (200, 400, 800):
        entries = spark.range(m).selectExpr("explode(sequence(0L, 31L)) AS key", "id AS node", "id AS root")
        assert minhash._with_leaders(entries, [1, 2, 3]).count() <= 3 * 32 * m


def test_pipeline_drops_near_copies_of_likeness_above_0_8(spark):
    base = [f"w{i}" for i in range(120)]
    near, far = list(base), list(base)
    near[30] = near[70] = "other"  # 10 of 116 shingles: 106 / 126
    for i in range(5, 120, 20):
        far[i] = "other"  # 30 of 116 shingles: 86 / 146
    rows = [(i, " ".join(w), "s", "en", None) for i, w in enumerate((base, near, far))]
    kept = corpus_pipeline.simhash_dedup(spark, frame(spark, rows), "")
    assert sorted(r.doc_id for r in kept.collect()) == [0, 2]
