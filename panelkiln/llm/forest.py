"""Approximate nearest neighbours by a forest of random-projection trees.

A tree halves a sample of the directions again and again: every level has a
random unit vector, every node the median of its sample rows' projections. All
rows are then filed under a leaf of each tree. A query goes through the nodes of
all trees by one priority queue: a node's weight is the chance that a neighbour
of likeness c, as the query has in the sample, lies below it. For a random
direction w and unit vectors of cosine c, a neighbour's projection is about normal around
c times the query's, with deviation sqrt((1 - c * c) / d). Leaves are
taken until the chance that all trees miss a neighbour is small enough; so a
query in a dense group takes few, one without near neighbours takes many.
Rows of the leaves taken are compared exactly.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from panelkiln.llm.vectors import matrix, usable
from panelkiln.session import stored

#: Rows that the trees are fitted to at most; all rows are filed and searched.
SAMPLE = 16_384
TREES = 3
SEED = 42

#: Rows of a leaf aimed at, and sample rows that a leaf has at least.
LEAF, LEAST = 512, 16

#: Rows that are compared at once: a fuller leaf is dealt to several tasks. Queries that meet them at once.
BLOCK, TOGETHER = 4096, 512

#: Chance that a neighbour is in a leaf taken.
TARGET = 0.95

FOUND = "query_id long, vec_id long, score double"


@dataclass
class Tree:
    """Nodes by level order from 1: children of i are 2i and 2i + 1; a node without a cut is a leaf."""

    directions: np.ndarray
    cuts: dict[int, float]

    def leaves(self, units: np.ndarray) -> np.ndarray:
        """The leaf of each row."""
        sides = units @ self.directions
        node = np.ones(len(units), np.int64)
        table = np.full(2 << self.directions.shape[1], np.nan)
        table[list(self.cuts)] = list(self.cuts.values())
        for level in range(self.directions.shape[1]):
            cut = table[node]
            node = np.where(np.isnan(cut), node, 2 * node + (sides[:, level] > cut))
        return node


@dataclass
class Forest:
    trees: list[Tree]
    sample: np.ndarray
    ids: list[list[int]]

    @classmethod
    def fit(cls, vectors: np.ndarray, ids: list[list[int]], rows: int, trees: int, leaf: int, seed: int) -> Forest:
        units = unit(vectors)
        rng = np.random.default_rng(seed)
        least = max(min(LEAST, leaf), math.ceil(leaf * len(units) / max(rows, 1)))
        depth = max(0, math.ceil(math.log2(max(len(units), 1) / least))) if len(units) else 0
        grown = []
        for _ in range(trees):
            directions = rng.normal(size=(units.shape[1], depth))
            if depth <= units.shape[1]:
                directions = np.linalg.qr(directions)[0]  # no two levels tell the same
            directions = directions / np.linalg.norm(directions, axis=0)
            sides, cuts, open_nodes = units @ directions, {}, [(1, np.arange(len(units)), 0)]
            while open_nodes:
                node, members, level = open_nodes.pop()
                if level == depth or len(members) <= least:
                    continue
                here = np.sort(sides[members, level])
                middle = len(here) // 2
                if here[0] == here[-1]:
                    continue
                cuts[node] = (here[middle - 1] + here[middle]) / 2
                right = sides[members, level] > cuts[node]
                open_nodes += [(2 * node, members[~right], level + 1), (2 * node + 1, members[right], level + 1)]
            grown.append(Tree(directions, cuts))
        return cls(grown, units.astype(np.float32), ids)

    def likeness(self, ids: np.ndarray, units: np.ndarray, k: int) -> np.ndarray:
        """Cosine of each query's k-th nearest row of the sample: no more than that of its k-th nearest at all.

        -1 where the sample has fewer rows.
        """
        out = np.full(len(units), -1.0)
        for i in range(0, len(units), TOGETHER):
            likes = units[i : i + TOGETHER] @ self.sample.T.astype(np.float64)
            near = min(k + 1, likes.shape[1])
            for j, row in enumerate(likes):
                own, had = ids[i + j], 0
                best = np.argpartition(-row, near - 1)[:near] if near else []
                for at in sorted(best, key=lambda b: -row[b]):
                    had += len(self.ids[at]) - (own in self.ids[at])
                    if had >= k:
                        out[i + j] = min(row[at], 1.0)
                        break
        return out

    def taken(self, units: np.ndarray, likeness: np.ndarray, target: float) -> Iterator[list[tuple[int, int]]]:
        """(tree, leaf) pairs for each query, heaviest first."""
        sides = [units @ tree.directions for tree in self.trees]
        root_d = math.sqrt(units.shape[1])
        for q, c in enumerate(likeness):
            if target >= 1 or c <= 0:  # nothing is known of its neighbours: all leaves of a tree
                yield list(self._all_leaves())
                continue
            spread = max(math.sqrt(max(0.0, 1 - c * c)) / root_d, 1e-9) * math.sqrt(2)
            queue = [(-1.0, t, 1) for t in range(len(self.trees))]
            missed, out = [1.0] * len(self.trees), []
            while queue:
                weight, t, node = heapq.heappop(queue)
                cut = self.trees[t].cuts.get(node)
                if cut is None:
                    out.append((t, node))
                    missed[t] = max(0.0, missed[t] + weight)
                    if math.prod(missed) <= 1 - target:
                        break
                    continue
                left = 0.5 * math.erfc((c * sides[t][q, node.bit_length() - 1] - cut) / spread)
                heapq.heappush(queue, (weight * left, t, 2 * node))
                heapq.heappush(queue, (weight * (1 - left), t, 2 * node + 1))
            yield out

    def _all_leaves(self) -> Iterator[tuple[int, int]]:
        open_nodes = [1]
        while open_nodes:
            node = open_nodes.pop()
            if node in self.trees[0].cuts:
                open_nodes += [2 * node, 2 * node + 1]
            else:
                yield 0, node


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows of length one, however large or small their numbers are."""
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Of rows with rows; equal rows give equal figures wherever they stand."""
    return (a * b).sum(axis=1) / (np.sqrt((a * a).sum(axis=1)) * np.sqrt((b * b).sum(axis=1)))


def _distinct(rows: DataFrame, ids: int) -> DataFrame:
    """(vec, ids): each vector once, with its ``ids`` smallest ids; no more of them can be among a query's nearest."""
    first = Window.partitionBy("vec").orderBy("vec_id")
    few = rows.distinct().withColumn("place", F.row_number().over(first)).where(F.col("place") <= ids)
    return few.groupBy("vec").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))


def _fitted(filed: DataFrame, rows: int, trees: int, sample: int, leaf: int, seed: int) -> Forest:
    """The forest of the ``sample`` rows of least hash, or of all."""
    some = filed.select("vec", "ids").orderBy(F.xxhash64(F.lit(seed), F.col("ids")[0]), F.col("ids")[0]).limit(sample).toArrow()
    return Forest.fit(matrix(some.column("vec")), some.column("ids").to_pylist(), rows, trees, leaf, seed)


def _filed(distinct: DataFrame, forest) -> DataFrame:
    """(leaf of each tree, ids, vec) of every vector."""
    vec_type = distinct.schema["vec"].dataType.simpleString()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            units = unit(matrix(batch.column("vec"))) if batch.num_rows else np.zeros((0, 1))
            leaves = np.stack([tree.leaves(units) for tree in forest.value.trees], axis=1) if batch.num_rows else np.zeros((0, 1), np.int64)
            column = pa.array(leaves.tolist(), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column("vec"), batch.column("ids"), column], ["vec", "ids", "leaves"])

    return distinct.select("vec", "ids").mapInArrow(scan, f"vec {vec_type}, ids array<long>, leaves array<long>")


def _sent(queries: DataFrame, forest, k: int, target: float) -> DataFrame:
    """(tree, leaf, query_id, vec): queries at the leaves they look into."""
    vec_type = queries.schema["vec"].dataType.simpleString()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for i in range(0, whole.num_rows, TOGETHER):
                batch = whole.slice(i, TOGETHER)
                ids, units = batch.column("vec_id").to_numpy(), unit(matrix(batch.column("vec")))
                chosen = list(forest.value.taken(units, forest.value.likeness(ids, units, k), target))
                who = np.repeat(np.arange(len(chosen)), [len(c) for c in chosen])
                pairs = np.array([p for c in chosen for p in c], np.int64).reshape(-1, 2)
                rows = batch.take(pa.array(who))
                columns = [pa.array(pairs[:, 0]), pa.array(pairs[:, 1]), rows.column("vec_id"), rows.column("vec")]
                yield pa.RecordBatch.from_arrays(columns, ["tree", "leaf", "query_id", "vec"])

    return queries.select("vec_id", "vec").mapInArrow(scan, f"tree long, leaf long, query_id long, vec {vec_type}")


class _Block:
    """Rows that queries are compared with: their vectors, and each vector's ids in as many columns as a vector has at most."""

    def __init__(self, parts: list[tuple[np.ndarray, list[list[int]]]]):
        self.rows = np.concatenate([p[0] for p in parts])
        self.units = unit(self.rows)
        lists = [ids for p in parts for ids in p[1]]
        lengths = np.array([len(x) for x in lists])
        self.filled = np.arange(lengths.max()) < lengths[:, None]
        self.ids = np.zeros(self.filled.shape, np.int64)
        self.ids[self.filled] = np.concatenate(lists)


def _nearest(block: _Block, ids: np.ndarray, vectors: np.ndarray, k: int) -> Iterator[pa.RecordBatch]:
    """Each query's k nearest of a block, and whatever comes so close that the exact figures have to tell.

    Of a vector's ids the smallest k beside the query's own are named.
    """
    for i in range(0, len(ids), TOGETHER):
        some, own = vectors[i : i + TOGETHER], ids[i : i + TOGETHER]
        likes = unit(some) @ block.units.T
        near = min(k + 1, likes.shape[1])
        bar = -np.partition(-likes, near - 1, axis=1)[:, near - 1 : near]
        q, at = np.nonzero(likes >= bar - 1e-9)
        scores = cosines(some[q], block.rows[at])
        found_ids = block.ids[at]
        take = block.filled[at] & (found_ids != own[q][:, None])
        pair, _ = np.nonzero(take)
        columns = [pa.array(own[q[pair]]), pa.array(found_ids[take]), pa.array(scores[pair])]
        yield pa.RecordBatch.from_arrays(columns, ["query_id", "vec_id", "score"])


def _met(stream: DataFrame, k: int) -> DataFrame:
    """Candidates (query_id, vec_id, score) from rows sorted by block, rows before queries."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, parts, block = None, [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.stack([batch.column(c).to_numpy() for c in ("tree", "leaf", "block", "kind")], axis=1)
            cuts = [0, *(np.flatnonzero((np.diff(keys, axis=0) != 0).any(axis=1)) + 1).tolist(), batch.num_rows]
            for start, stop in zip(cuts, cuts[1:]):
                piece = batch.slice(start, stop - start)
                if key != tuple(keys[start, :3]):
                    key, parts, block = tuple(keys[start, :3]), [], None
                if keys[start, 3] == 0:
                    parts.append((matrix(piece.column("vec")), piece.column("ids").to_pylist()))
                elif parts:
                    if block is None:
                        block = _Block(parts)
                    yield from _nearest(block, piece.column("query_id").to_numpy(), matrix(piece.column("vec")), k)

    return stream.mapInArrow(scan, FOUND)


def nearest(
    rows: DataFrame,
    queries: DataFrame,
    k: int = 5,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    target: float = TARGET,
    trees: int = TREES,
    sample: int = SAMPLE,
    leaf: int = LEAF,
    block: int = BLOCK,
    seed: int = SEED,
) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's ``k`` rows of largest cosine among those found, ties to the smaller id.

    A neighbour is found with a chance of about ``target``, by the model above; 1 finds all, by looking
    everywhere. ``sample`` bounds the rows that trees are fitted to, not those that
    are searched. Fewer than ``k`` candidates at all are returned all.

    Vectors that are null, empty, zero, of an unusual length, or hold a null or a number that isn't finite take no
    part, nor do rows without an id. Rows of one id are one
    item: it is as near as the nearest of its vectors, is never its own neighbour, and
    repeated rows change nothing. Copies of a vector under many ids are compared once. An
    empty table gives an empty table. Other columns play no part.
    """
    spark = rows.sparkSession
    not_zero = F.exists("vec", lambda c: c != 0)
    own = usable(rows, id_col, vector_col).where(F.col("vec_id").isNotNull() & not_zero)
    distinct = stored(_distinct(own, k + 1), "vectors")
    count = distinct.count()
    if not count:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    forest = spark.sparkContext.broadcast(_fitted(distinct, count, trees, sample, leaf, seed))
    filed = stored(_filed(distinct, forest), "leaves").select("vec", "ids", F.posexplode("leaves").alias("tree", "leaf"))
    filed = filed.withColumn("tree", F.col("tree").cast("long"))
    # At most trees * sample / LEAST rows, however large the table is.
    sizes = filed.groupBy("tree", "leaf").agg(F.count(F.lit(1)).alias("n"))
    blocks = F.broadcast(stored(sizes.select("tree", "leaf", F.ceil(F.col("n") / block).alias("blocks")), "blocks"))
    dealt = filed.join(blocks, ["tree", "leaf"]).select(
        "tree", "leaf", F.pmod(F.xxhash64(F.col("ids")[0]), "blocks").alias("block"), F.lit(0).alias("kind"), F.lit(None).cast("long").alias("query_id"), "ids", "vec"
    )
    asked = usable(queries, id_col, vector_col).where(F.col("vec_id").isNotNull() & not_zero).distinct()
    sent = _sent(asked, forest, k, target).join(blocks, ["tree", "leaf"]).select(
        "tree", "leaf", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"), F.lit(1).alias("kind"), "query_id",
        F.lit(None).cast("array<long>").alias("ids"), "vec",
    )
    keys = ("tree", "leaf", "block")
    found = _met(dealt.union(sent).repartition(*keys).sortWithinPartitions(*keys, "kind"), k)
    best = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
