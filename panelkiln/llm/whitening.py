"""Whitening of embeddings from exact integer sums: covariances by polarisation.

Numbers become integers x = floor(256 c); with n distinct vectors of
per-dimension sums S, the centred value y = n x - S is an integer too. What Spark aggregates
are sums of squares only, of y_i for every dimension and of y_i + y_j for every
pair; by (y_i + y_j)^2 = y_i^2 + y_j^2 + 2 y_i y_j their differences give all
cross-covariances. The sums are exact, however they are grouped, so that reruns
and lost tasks change nothing; rounding starts with the d x d matrix handed to ``eigh``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from panelkiln.llm.vectors import usable
from panelkiln.session import stored

SCALE = 256
COMPONENTS = 4

#: An exact sum travels as numbers of 40 bits (the last one signed), which Spark adds up one by one.
LIMB, LIMBS = 40, 8
_SUMS = "i int, j int, " + ", ".join(f"l{k} long" for k in range(LIMBS))

#: Rows whose squares are summed in 64 bits: of numbers below 2^26 as they are, of wider ones in halves of 28 bits.
_NARROW, _ROWS = 26, 1024
_WIDE, _FEW = 55, 64


class ExactSum:
    """Sums of int64 arrays of one shape, with no overflow before 2^31 of them."""

    def __init__(self, shape: tuple[int, ...]):
        self.high, self.low = np.zeros(shape, np.int64), np.zeros(shape, np.int64)

    def add(self, values: np.ndarray) -> None:
        self.high += values >> 32
        self.low += values & 0xFFFFFFFF

    def total(self) -> np.ndarray:
        return (self.high.astype(object) << 32) + self.low.astype(object)


def squares(y: np.ndarray) -> np.ndarray:
    """Sums over rows of (y_i + y_j)^2 for i < j, and of y_i^2 for i = j, as Python ints; the lower triangle is zero."""
    d = y.shape[1]
    total = np.zeros((d, d), object)
    if not len(y):
        return total
    if y.dtype == object or int(np.abs(y).max()).bit_length() + 1 > _WIDE:
        y = y.astype(object)
        for i in range(d):
            z = y[:, i:] + y[:, i : i + 1]
            z[:, 0] = y[:, i]
            total[i, i:] = (z * z).sum(axis=0)
        return total
    wide = int(np.abs(y).max()).bit_length() + 1 > _NARROW
    rows = _FEW if wide else _ROWS
    sums = [ExactSum((d, d)) for _ in range(3 if wide else 1)]
    for at in range(0, len(y), rows):
        block = np.ascontiguousarray(y[at : at + rows].T)
        parts = [np.zeros((d, d), np.int64) for _ in sums]
        for i in range(d):
            z = block[i:] + block[i]
            z[0] = block[i]
            if wide:
                a, b = z >> 28, z & 0xFFFFFFF
                for part, product in zip(parts, (a * a, a * b, b * b)):
                    part[i, i:] = product.sum(axis=1)
            else:
                parts[0][i, i:] = np.einsum("ij,ij->i", z, z)
        for s, part in zip(sums, parts):
            s.add(part)
    if not wide:
        return sums[0].total()
    high, cross, low = (s.total() for s in sums)
    return (high << 56) + (cross << 29) + low


def centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n x - S, in 64 bits where that can hold it and in Python ints elsewhere."""
    if len(x) and n * max(abs(int(x.max())), abs(int(x.min()))) + max(map(abs, sums)) >= 1 << 62:
        return x.astype(object) * n - np.array(sums, object)
    return x * n - np.array(sums, np.int64)


def _limbs(value: int) -> list[int]:
    out = []
    for _ in range(LIMBS - 1):
        out.append(value & ((1 << LIMB) - 1))
        value >>= LIMB
    return [*out, value]


def _summed(x: DataFrame, work) -> dict[tuple[int, int], int]:
    """Exact sums by (i, j). ``work`` gives a task's own from its matrices of x; they are few: one row for each pair and task."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = work(_integers(b.column("x")) for b in batches if b.num_rows)
        if found is not None:
            i, j = np.triu_indices(found.shape[1]) if found.shape[0] > 1 else (np.zeros(found.shape[1], int), np.arange(found.shape[1]))
            limbs = np.array([_limbs(int(v)) for v in found[i, j]], np.int64).reshape(-1, LIMBS)
            columns = [pa.array(i, pa.int32()), pa.array(j, pa.int32()), *(pa.array(limbs[:, k]) for k in range(LIMBS))]
            yield pa.RecordBatch.from_arrays(columns, ["i", "j", *(f"l{k}" for k in range(LIMBS))])

    sums = x.mapInArrow(scan, _SUMS).groupBy("i", "j").agg(*[F.sum(f"l{k}").alias(f"l{k}") for k in range(LIMBS)])
    return {(r[0], r[1]): sum(v << (LIMB * k) for k, v in enumerate(r[2:])) for r in sums.collect()}


def _integers(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy().reshape(len(column), -1)


def _totals(matrices: Iterator[np.ndarray]) -> np.ndarray | None:
    total = None
    for x in matrices:
        for at in range(0, len(x), 1 << 20):
            high, low = x[at : at + (1 << 20)] >> 32, x[at : at + (1 << 20)] & 0xFFFFFFFF
            part = (high.sum(axis=0).astype(object) << 32) + low.sum(axis=0).astype(object)
            total = part if total is None else total + part
    return None if total is None else total[None, :]


@dataclass
class Whitener:
    """What whitening takes: n, S, and the components with their variances, falling; ``trace`` is the sum of all variances."""

    n: int
    sums: list[int]
    variances: np.ndarray
    components: np.ndarray
    trace: float

    def of(self, y: np.ndarray) -> np.ndarray:
        """One column for each component, from centred values."""
        return (y.astype(np.float64) / self.n) @ self.components / np.sqrt(self.variances)


def _quantised(rows: DataFrame) -> DataFrame:
    """(vec_id, x) with x = floor(SCALE * c); what is beyond longs becomes the nearest long."""
    return rows.select("vec_id", F.transform("vec", lambda c: F.floor(c.cast("double") * F.lit(float(SCALE)))).alias("x"))


def covariances(n: int, sums: dict[tuple[int, int], int]) -> tuple[np.ndarray, float]:
    """V and its trace, each entry rounded once from exact integers; divisor n."""
    d = max(j for _, j in sums) + 1
    v = np.zeros((d, d))
    for (i, j), total in sums.items():
        cross = total if i == j else (total - sums[i, i] - sums[j, j]) // 2
        v[i, j] = v[j, i] = cross / n**3
    return v, sum(sums[i, i] for i in range(d)) / n**3


def _fit(distinct: DataFrame, components: int) -> Whitener | None:
    n = distinct.count()
    if not n:
        return None
    totals = _summed(distinct, _totals)
    sums = [totals[0, j] for j in range(len(totals))]

    def work(matrices: Iterator[np.ndarray]) -> np.ndarray | None:
        total = None
        for x in matrices:
            part = squares(centred(x, n, sums))
            total = part if total is None else total + part
        return total

    v, trace = covariances(n, _summed(distinct, work))
    values, vectors = np.linalg.eigh(v)
    order = [k for k in np.argsort(-values, kind="stable")[:components] if values[k] > trace * len(v) * 2e-15]
    vectors = vectors[:, order]
    signs = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(len(order))])
    return Whitener(n, sums, values[order], vectors * signs, trace)


def _identity_error(distinct: DataFrame, fitted: Whitener) -> float:
    """Largest absolute entry of the whitened vectors' covariance less the identity, centred within tasks and then between them."""
    k = len(fitted.variances)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, mean, cross = 0, np.zeros(k), np.zeros((k, k))
        for batch in batches:
            if not batch.num_rows:
                continue
            w = fitted.of(centred(_integers(batch.column("x")), fitted.n, fitted.sums))
            own = w.mean(axis=0)
            step, both = own - mean, count + len(w)
            cross += (w - own).T @ (w - own) + np.outer(step, step) * (count * len(w) / both)
            mean, count = mean + step * (len(w) / both), both
        if count:
            a, b = (x.ravel() for x in np.indices((k, k)))
            columns = [pa.array(a), pa.array(b), pa.array([float(count)] * k * k), pa.array(mean[a]), pa.array(mean[b]), pa.array(cross.ravel())]
            yield pa.RecordBatch.from_arrays(columns, ["a", "b", "n", "mean_a", "mean_b", "cross"])

    parts = stored(distinct.mapInArrow(scan, "a long, b long, n double, mean_a double, mean_b double, cross double"), "moments")
    means = F.create_map(*[F.lit(x) for r in parts.where("b = 0").groupBy("a").agg(F.sum(F.col("n") * F.col("mean_a"))).collect() for x in (r[0], r[1] / fitted.n)])
    between = F.col("n") * (F.col("mean_a") - means[F.col("a")]) * (F.col("mean_b") - means[F.col("b")])
    cells = parts.groupBy("a", "b").agg((F.sum(F.col("cross") + between) / fitted.n).alias("v"))
    return cells.agg(F.max(F.abs(F.col("v") - F.when(F.col("a") == F.col("b"), 1.0).otherwise(0.0)))).first()[0]


def whiten(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """One row per vector and component: vec_id, component (from 1), n, deviation, whitened, explained, identity_error.

    Vectors that are null or empty, hold a null or a number that isn't finite, or are of an unusual length take no part.
    Copies of a vector of integers are fitted once, but each row has its own result, repeated rows and rows without an id
    too. ``deviation`` is the sum over dimensions of (n x - S)^2, exact up to 38 digits and null beyond; ``explained`` the component's
    share of all variance. Components without variance are left out, so that equal vectors, a single one and an empty
    table give no rows. Signs are such that a component's largest entry is positive. Memory: d^2 numbers a task.
    Other columns play no part.
    """
    spark = rows.sparkSession
    schema = "vec_id long, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
    own = _quantised(usable(rows, id_col, vector_col))
    distinct = stored(own.select("x").distinct(), "integers")
    fitted = _fit(distinct, components)
    if fitted is None or not len(fitted.variances):
        return spark.createDataFrame([], schema)
    error, k = _identity_error(distinct, fitted), len(fitted.variances)
    shares = fitted.variances / fitted.trace

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            y = centred(_integers(batch.column("x")), fitted.n, fitted.sums)
            w = fitted.of(y)
            if y.dtype == object or 2 * int(np.abs(y).max()).bit_length() + math.ceil(math.log2(y.shape[1])) > 62:
                y = y.astype(object)
            deviation = (y * y).sum(axis=1)
            if deviation.dtype == object:
                deviation = pa.array([v if v < 10**38 else None for v in deviation], pa.decimal128(38, 0))
            else:
                deviation = pa.array(deviation).cast(pa.decimal128(38, 0))
            each = np.repeat(np.arange(len(w)), k)
            number = np.tile(np.arange(k), len(w))
            columns = [
                batch.column("vec_id").take(pa.array(each)), pa.array(number + 1, pa.int32()), pa.array(np.full(len(each), fitted.n)), deviation.take(pa.array(each)),
                pa.array(w.ravel()), pa.array(shares[number]), pa.array(np.full(len(each), error)),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return own.mapInArrow(scan, schema)
