"""Nearest neighbours and whitening against brute force."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelkiln.llm import forest, whitening

SCHEMA = "vec_id long, embedding array<float>, label int"


def usable(rows, zero=False):
    fine = [(i, v) for i, v, _ in rows if v and len(v) == 6 and all(c is not None and math.isfinite(c) for c in v)]
    return [(i, np.array(v, np.float32).astype(float)) for i, v in fine if zero or any(v)]


def odd_vectors(n=400, seed=1, dims=6):
    """Groups of near copies, copies under many ids, ties, rows of one id, and rows that take no part."""
    rng = random.Random(seed)
    rows = [(i, [rng.gauss(0, 1) for _ in range(dims)], 0) for i in range(n)]
    rows += [(n + i, [c + rng.gauss(0, 1e-3) for c in rows[7][1]], 1) for i in range(n // 2)]
    rows += [(2 * n + i, rows[3][1], 2) for i in range(60)]
    rows += [(3 * n + i, [2 * c for c in rows[5][1]], 2) for i in range(9)]
    rows += rows[:20] + [(50, rows[60][1], 3), (50, rows[61][1], 3)]
    rows += [(None, rows[0][1], 4), (9000, None, 4), (9050, [], 4), (9100, [0.0] * dims, 4), (9150, [1.0] * (dims - 1), 4)]
    rows += [(9200, [None] + [1.0] * (dims - 1), 4), (9250, [float("nan")] + [1.0] * (dims - 1), 4), (9300, [float("inf")] * dims, 4)]
    rows += [(9350, [1e-30] * dims, 4), (-50, [1.0] + [0.0] * (dims - 1), 4)]
    return rows


def brute_nearest(rows, queries, k):
    items = {}
    for i, v in usable(rows):
        if i is not None:
            items.setdefault(i, []).append(v)
    asked = {}
    for i, v in usable(queries):
        if i is not None:
            asked.setdefault(i, []).append(v)
    cosine = lambda a, b: float(forest.cosines(a[None], b[None])[0])
    out = {}
    for q, vectors in asked.items():
        scores = [(-max(cosine(a, b) for a in vectors for b in other), i) for i, other in items.items() if i != q]
        out[q] = sorted(scores)[:k]
    return out


def test_nearest_exact(spark):
    rows = odd_vectors()
    df = spark.createDataFrame(rows, SCHEMA).withColumn("leaf", F.lit("x")).withColumn("vec", F.lit(1)).repartition(5)
    queries = df.where("vec_id % 50 = 0")
    want = brute_nearest(rows, [r for r in rows if r[0] is not None and r[0] % 50 == 0], 5)
    got = {}
    for r in forest.nearest(df, queries, target=1.0, leaf=16, block=64).collect():
        got.setdefault(r.query_id, {})[r["rank"]] = (-r.score, r.vec_id)
    assert {q: [v[i + 1] for i in range(len(v))] for q, v in got.items()} == want


def test_nearest_recall(spark):
    rows = odd_vectors(n=1500, seed=2)
    df = spark.createDataFrame(rows, SCHEMA)
    queries = df.where("vec_id % 10 = 0")
    want = brute_nearest(rows, [r for r in rows if r[0] is not None and r[0] % 10 == 0], 5)
    found = forest.nearest(df, queries, sample=500, leaf=32, block=100).collect()
    scores = {}
    for r in found:
        scores.setdefault(r.query_id, []).append(r.score)
    # By score, as a tie may be told either way: how many found are as near as the true fifth.
    hits = sum(sum(s >= -want[q][-1][0] - 1e-12 for s in v) for q, v in scores.items())
    assert set(scores) == set(want) and hits >= 0.9 * 5 * len(want)


def test_forest_looks_into_few_leaves_for_near_copies():
    rng = np.random.default_rng(0)
    centres = rng.normal(size=(200, 32))
    vectors = np.repeat(centres, 40, axis=0) + rng.normal(scale=0.01, size=(8000, 32))
    grown = forest.Forest.fit(vectors, [[i] for i in range(8000)], 8000, 3, 64, 1)
    units = forest.unit(vectors[::400])
    likeness = grown.likeness(np.arange(0, 8000, 400), units, 5)
    taken = list(grown.taken(units, likeness, 0.95))
    assert likeness.min() > 0.99
    assert np.mean([len(t) for t in taken]) < 30  # of over 200 in three trees
    assert all(abs(sum(1 for _ in grown._all_leaves()) - len(t)) == 0 for t in grown.taken(units[:1], likeness[:1], 1.0))


def test_nearest_with_few_rows(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert forest.nearest(empty, empty).collect() == []
    two = spark.createDataFrame([(1, [1.0, 0.0], 0), (2, [1.0, 1.0], 0)], SCHEMA)
    got = [tuple(r) for r in forest.nearest(two, two).orderBy("query_id").collect()]
    assert [r[:3] for r in got] == [(1, 1, 2), (2, 1, 1)]
    assert got[0][3] == pytest.approx(2**-0.5, abs=1e-15)
    assert forest.nearest(two, empty).collect() == []


def brute_whitening(rows, k):
    """By Python ints, and a covariance matrix that is rounded once."""
    fine = [(i, [math.floor(256 * c) for c in v]) for i, v in usable(rows, zero=True)]
    fit = [list(x) for x in {tuple(x) for _, x in fine}]
    n, d = len(fit), len(fit[0])
    sums = [sum(x[j] for x in fit) for j in range(d)]
    centred = [[n * x[j] - sums[j] for j in range(d)] for x in fit]
    v = np.array([[sum(y[i] * y[j] for y in centred) / n**3 for j in range(d)] for i in range(d)])
    values, vectors = np.linalg.eigh(v)
    values, vectors = values[::-1][:k], vectors[:, ::-1][:, :k]
    found = {}
    for i, x in fine:
        y = [n * x[j] - sums[j] for j in range(d)]
        whitened = np.array([c / n for c in y]) @ vectors / np.sqrt(values)
        found.setdefault((i, tuple(x)), []).append((sum(c * c for c in y), whitened))
    return n, found, values / np.trace(v), fine


def test_whitening(spark):
    rows = [r for r in odd_vectors() if r[0] != 9300]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("x", F.lit("other")).withColumn("component", F.lit(1)).repartition(5)
    n, want, shares, fine = brute_whitening(rows, 4)
    got = whitening.whiten(df).collect()
    assert len(got) == 4 * len(fine)
    sides = {}
    for r in got:
        k = r.component - 1
        assert r.n == n and abs(r.explained - shares[k]) < 1e-12 and r.identity_error < 1e-9
        near = [w for i, ws in want.items() if i[0] == r.vec_id for w in ws if w[0] == int(r.deviation)]
        assert near
        side = next((s for s in (1, -1) for w in near if abs(abs(r.whitened) - abs(w[1][k])) < 1e-9 and abs(s * r.whitened - w[1][k]) < 1e-9), None)
        assert side
        if abs(r.whitened) > 1e-6:
            sides.setdefault(k, set()).add(side)
    assert all(len(s) == 1 for s in sides.values()) and len(sides) == 4


@pytest.mark.parametrize("bits", [4, 22, 26, 40, 54, 61, 90])
def test_exact_squares(bits):
    rng = random.Random(bits)
    y = [[rng.randint(-(1 << bits), 1 << bits) for _ in range(5)] for _ in range(3000)] + [[1 << bits] * 5, [-(1 << bits)] * 5]
    got = whitening.squares(np.array(y, np.int64 if bits < 63 else object))
    for i in range(5):
        for j in range(i, 5):
            assert got[i, j] == sum((r[i] + r[j]) ** 2 if i < j else r[i] ** 2 for r in y)


def test_covariances_by_polarisation():
    rng = np.random.default_rng(4)
    x = rng.integers(-300, 300, size=(500, 7)) + 10**6  # a mean that would drown float sums of squares
    sums = [int(s) for s in x.sum(axis=0)]
    squares = whitening.squares(whitening.centred(x, 500, sums))
    v, trace = whitening.covariances(500, {(i, j): squares[i, j] for i in range(7) for j in range(i, 7)})
    assert np.allclose(v, np.cov(x.T.astype(float), bias=True), rtol=1e-9, atol=1e-6) and trace == pytest.approx(np.trace(v))


def test_whitening_without_variance(spark):
    for rows in ([], [(1, [1.0, 2.0], 0)], [(i, [1.0, 2.0], 0) for i in range(5)], [(1, None, 0), (2, [], 0)]):
        assert whitening.whiten(spark.createDataFrame(rows, SCHEMA)).collect() == []
    flat = whitening.whiten(spark.createDataFrame([(i, [float(i), 1.0], 0) for i in range(4)] + [(None, [9.0, 1.0], 0)], SCHEMA)).collect()
    assert {r.component for r in flat} == {1} and len(flat) == 5 and all(r.explained == pytest.approx(1) for r in flat)
    huge = spark.createDataFrame([(i, [1e30 * (-1) ** i, 1e-30 * i], 0) for i in range(6)], SCHEMA)  # (nearest long, 0)
    assert whitening.whiten(huge).count() == 6
