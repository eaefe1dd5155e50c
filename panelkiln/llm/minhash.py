"""Near copies by exact Jaccard likeness of word shingles; candidates by SimHash classes and MinHash bands.

A text is the set of its shingles' hashes. Candidates come from two sources. The classes of
SimHash fingerprints (``simhash.links``: pigeonring chains within two bits) hold most near copies.
For what they leave apart (64 bits differ in about ten places at a likeness of 0.8) there are 32 bands of four
minima: a pair of likeness 0.8 shares a band of four minima with a chance of 0.41, and none of 32 with one of 5e-8.

Comparing all that meet in a band would take as many pairs as the square of a
group's size, however few of them link. So every text is compared with
a few leaders only: with one of all its bands first, by which large groups of near copies find together, and what is
apart then with three of each band, by other orders in each; a group needs no more than some of its links to be found whole. A pair of 0.8 meets in about 13 bands.
Leaders can miss a link, so what shares a band and is still apart is compared last, pair by pair. A link between two classes rests on
shingles that both have, so only those that are in several classes count: a text that has them for less than 0.8 of its set has no link to
come, and of the others' common shingles the likeness has to be so much higher (0.94 where a tenth of both sets is their own) that 1024 minima
of one bit tell links from what only comes near them. Where pairs meet, they are held to that, and each leaves the join once, at the least
key it shares; the likeliest pair of each two classes is compared first, the others if that leaves them apart. ``exact=False`` leaves this step out.
Before texts are fetched, pairs have to be of like size, and the share of 128 equal minima
is an estimate that is allowed 4.5 deviations. What passes is compared shingle by shingle.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from panelkiln.llm import packed
from panelkiln.llm.common import keyed, text_key, utf8
from panelkiln.llm.components import components
from panelkiln.llm.simhash import fingerprint, links
from panelkiln.session import Scratch, stored

SHINGLE = 5
SIMILARITY = 0.8
BANDS = 32
ROWS = 4
SEED = 42

#: Hashes that are permuted at once.
_BLOCK = 1 << 16

#: Rounds of pairs with leaders after that with one, and leaders of each band in a round.
ROUNDS, LEADERS = 1, 3

#: Tasks that a leader's pairs are dealt to at most, and documents that a task looks at together.
SLOTS, TOGETHER = 16, 1000

#: Deviations that the estimate of likeness may be short by, of whole minima and of one bit of each.
SLACK, BIT_SLACK = 4.5, 6.0

#: Pairs of one key that a task looks at; a greater key is dealt to several.
MEETINGS = 50_000_000

#: One-bit minima of the shingles in several classes, and the negative logarithm of the chance that a link fails by them (4e-8).
MARKS, CHANCE = 1024, 17.0

_random = np.random.default_rng(SEED)
_FLIP, _TIMES = (_random.integers(1 << 63, size=(BANDS * ROWS, 1), dtype=np.uint64) * np.uint64(2) + np.uint64(1) for _ in range(2))
_ROW = _random.integers(1 << 63, size=(BANDS, ROWS), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_MARK_FLIP, _MARK_TIMES = (_random.integers(1 << 63, size=(MARKS, 1), dtype=np.uint64) * np.uint64(2) + np.uint64(1) for _ in range(2))


def shingles(text: bytes | None, n: int = SHINGLE) -> np.ndarray:
    """Distinct hashes of the n-word shingles, ascending; a shorter text is one shingle."""
    words = (text or b"").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = min(n, len(words))
    spans = zip(starts[: len(words) - n + 1].tolist(), ends[n - 1 :].tolist())
    digest = xxhash.xxh64_intdigest
    return np.unique(np.fromiter((digest(line[s:e], SEED) for s, e in spans), np.uint64, len(words) - n + 1))


def minima(hashes: np.ndarray, flip: np.ndarray = _FLIP, times: np.ndarray = _TIMES) -> np.ndarray:
    """The least of the set's hashes under each of the permutations (128 by default); the greatest number for an empty set."""
    least = np.full(len(flip), np.iinfo(np.uint64).max, np.uint64)
    block = _BLOCK // len(flip)
    for i in range(0, len(hashes), block):
        np.minimum(least, ((hashes[i : i + block] ^ flip) * times).min(axis=1), out=least)
    return packed.mixed(least)


def bands(least: np.ndarray) -> np.ndarray:
    """A key for each band of minima, as signed longs."""
    keys = (least.reshape(BANDS, ROWS) * _ROW).sum(axis=1, dtype=np.uint64)
    return packed.mixed(keys).view(np.int64)


def sketch(least: np.ndarray) -> np.ndarray:
    """One bit of each of the minima, 64 in a signed long."""
    return np.packbits((least & np.uint64(1)).astype(np.uint8)).view("<i8")


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard likeness of two sets that are not both empty."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both)


def _few(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same rows, no more than ``TOGETHER`` in a batch."""
    return (whole.slice(i, TOGETHER) for whole in batches for i in range(0, whole.num_rows, TOGETHER))


def _marks(docs: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    """(doc_id, text_key, node, fingerprint, n, bands, minima, bits0, bits1) of every row; texts of equal shingles are one node.

    Of the minima 16 bits each are kept.
    """
    names = ["doc_id", "text_key", "node", "fingerprint", "n", "bands", "minima", "bits0", "bits1"]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _few(batches):
            texts = utf8(batch.column("text"))
            sets = [shingles(t, shingle) for t in texts]
            nodes = np.array([xxhash.xxh64_intdigest(s.tobytes(), SEED) for s in sets], np.uint64).view(np.int64)
            least = [minima(s) if len(s) else None for s in sets]
            bits = [(0, 0) if x is None else sketch(x).tolist() for x in least]
            columns = [
                batch.column("doc_id"), batch.column("text_key"), pa.array(nodes), pa.array([fingerprint(t) for t in texts], pa.int64()),
                pa.array([len(s) for s in sets], pa.int64()), pa.array([[] if x is None else bands(x) for x in least], pa.list_(pa.int64())),
                pa.array([b"" if x is None else (x & np.uint64(0xFFFF)).astype("<u2").tobytes() for x in least], pa.binary()),
                *(pa.array([b[i] for b in bits], pa.int64()) for i in range(2)),
            ]
            yield pa.RecordBatch.from_arrays(columns, names)

    rows = keyed(docs, id_col, text_col).withColumn("text_key", text_key(F.col("text")))
    return rows.mapInArrow(scan, "doc_id long, text_key long, node long, fingerprint long, n long, bands array<long>, minima binary, bits0 long, bits1 long")


def _alike(pairs: DataFrame, nodes: DataFrame, similarity: float) -> DataFrame:
    """Pairs (a, b) whose sizes allow the likeness (exact) and whose minima make it likely enough."""
    least = similarity - SLACK * (similarity * (1 - similarity) / (BANDS * ROWS)) ** 0.5

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            mine, others = (np.frombuffer(b"".join(batch.column(c).to_pylist()), "<u2").reshape(-1, BANDS * ROWS) for c in ("a_minima", "b_minima"))
            kept = batch.filter(pa.array((mine == others).mean(axis=1) >= least))
            yield pa.RecordBatch.from_arrays([kept.column("a"), kept.column("b")], ["a", "b"])

    one, other = (nodes.select(F.col("node").alias(c), F.col("n").alias(f"{c}_n"), F.col("minima").alias(f"{c}_minima")) for c in "ab")
    sized = pairs.join(other, "b").join(one, "a").where(F.least("a_n", "b_n") >= F.greatest("a_n", "b_n") * similarity - 1e-9)
    return sized.select("a", "b", "a_minima", "b_minima").mapInArrow(scan, "a long, b long")


def _verified(pairs: DataFrame, texts: DataFrame, shingle: int, similarity: float) -> DataFrame:
    """Pairs (a, b) of nodes whose likeness is ``similarity`` or more, by the texts themselves.

    The text of a travels once for all its pairs, or, as a leader has many, once for each of
    ``SLOTS`` slots they are dealt to; those of b follow it.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = None
        for batch in batches:
            good = []
            for first, text in zip(batch.column("is_first").to_pylist(), batch.column("text")):
                mine = shingles(text.as_buffer().to_pybytes(), shingle)
                own = mine if first else own
                good.append(not first and likeness(own, mine) >= similarity)
            kept = batch.filter(pa.array(good, pa.bool_()))
            yield pa.RecordBatch.from_arrays([kept.column("a"), kept.column("b")], ["a", "b"])

    dealt = pairs.withColumn("slot", F.pmod(F.xxhash64("b"), F.lit(SLOTS)))
    of_b = dealt.join(texts.select(F.col("node").alias("b"), "text"), "b").select("a", "slot", F.lit(False).alias("is_first"), "b", "text")
    of_a = dealt.select("a", "slot").distinct().join(texts.select(F.col("node").alias("a"), "text"), "a")
    of_a = of_a.select("a", "slot", F.lit(True).alias("is_first"), F.lit(None).cast("long").alias("b"), "text")
    stream = of_a.union(of_b).repartition("a", "slot").sortWithinPartitions("a", "slot", F.desc("is_first"))
    return stream.select("a", "b", "is_first", "text").mapInArrow(scan, "a long, b long")


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _with_leaders(entries: DataFrame, salts: list[int]) -> DataFrame:
    """Pairs of each node with the leaders of its keys that are of another class: a leader for each salt.

    ``entries`` are (key, node, root). Pairs are no more than entries times salts.
    """
    ranks = [F.min(F.struct(F.xxhash64(F.lit(salt), "key", "node").alias("rank"), F.col("node").alias("a"), F.col("root").alias("a_root"))) for salt in salts]
    leaders = entries.groupBy("key").agg(F.array(*ranks).alias("leaders"), F.min("root").alias("least"), F.max("root").alias("most"))
    open_keys = leaders.where("least <> most").select("key", "leaders")
    met = entries.join(open_keys, "key").select(F.col("node").alias("b"), "root", F.explode("leaders").alias("leader"))
    return met.where("root <> leader.a_root").select(F.col("leader.a").alias("a"), "b")


def _with_one_leader(entries: DataFrame, salt: int) -> DataFrame:
    """A pair for each node: with the leader that most of its keys are likely to share, by an order that is the same for all keys."""
    rank = F.min(F.struct(F.xxhash64(F.lit(salt), "node").alias("rank"), F.col("node").alias("a"), F.col("root").alias("a_root")))
    leaders = entries.groupBy("key").agg(rank.alias("leader"))
    met = entries.join(leaders, "key").where("root <> leader.a_root")
    return met.groupBy("node").agg(F.min("leader").alias("leader")).select("leader.a", F.col("node").alias("b"))


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, np.ndarray]]:
    """(node, n, its hashes) of rows (node, n, key) that come node by node, whatever batches they are in."""
    own, size, held = 0, 0, []
    for batch in batches:
        nodes, sizes, keys = (batch.column(c).to_numpy() for c in ("node", "n", "key"))
        starts = np.flatnonzero(np.concatenate((nodes[:1] == nodes[:1], nodes[1:] != nodes[:-1])))
        for start, end in zip(starts.tolist(), [*starts[1:].tolist(), len(nodes)]):
            if held and nodes[start] != own:
                yield own, size, np.concatenate(held)
                held = []
            own, size = int(nodes[start]), int(sizes[start])
            held.append(keys[start:end].view(np.uint64))
    if held:
        yield own, size, np.concatenate(held)


def _common(entries: DataFrame, texts: DataFrame, shingle: int, similarity: float, scratch: Scratch) -> DataFrame:
    """(node, common, mark0, mark1, ...) of the nodes that may have a link to another class: how many of their shingles are in several classes, and their minima.

    ``entries`` are (key, node, root), ``texts`` (node, text). A node with too few such shingles is left out: whatever it shares with another class is among them.
    """
    marks = [f"mark{i}" for i in range(MARKS // 64)]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _few(batches):
            sets = [shingles(t, shingle).view(np.int64) for t in utf8(batch.column("text"))]
            yield pa.RecordBatch.from_arrays([batch.column("node"), batch.column("root"), pa.array(sets, pa.list_(pa.int64()))], ["node", "root", "shingles"])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = ((node, h) for node, n, h in _runs(batches) if len(h) >= n * similarity - 1e-9)
        while some := list(islice(found, TOGETHER)):
            bits = np.array([sketch(minima(h, _MARK_FLIP, _MARK_TIMES)) for _, h in some])
            columns = [pa.array([node for node, _ in some], pa.int64()), pa.array([len(h) for _, h in some], pa.int64()), *(pa.array(c) for c in bits.T)]
            yield pa.RecordBatch.from_arrays(columns, ["node", "common", *marks])

    sets = entries.select("node", "root").distinct().join(texts, "node").select("node", "root", "text")
    sets = scratch.stored(sets.mapInArrow(cut, "node long, root long, shingles array<long>"), "shingles")
    rows = sets.select("node", "root", F.size("shingles").cast("long").alias("n"), F.explode("shingles").alias("key"))
    rows = _shared(rows, "root").select("node", "n", "key").repartition("node").sortWithinPartitions("node")
    return rows.mapInArrow(scan, ", ".join(f"{c} long" for c in ("node", "common", *marks)))


def _all_pairs(entries: DataFrame, nodes: DataFrame, similarity: float, common: DataFrame | None = None) -> DataFrame:
    """Pairs of all nodes that share a key, are of different classes and may be alike by size and by the bits of their minima.

    ``entries`` are (key, node, root). A key's greatest class is not held against itself, and a key of many pairs is dealt to
    several tasks: each has a part of the nodes outside that class, and all of the key's nodes to hold them against. With
    ``common`` (see ``_common``) only its nodes are paired, they have to be alike by it too, and a pair comes once: at the least key of both.
    """
    share = (1 - similarity) / 2
    most_bits = BANDS * ROWS * share + BIT_SLACK * (BANDS * ROWS * share * (1 - share)) ** 0.5
    columns, bits = ["node", "root", "n", "bits0", "bits1"], []
    if common is not None:
        bits = [c for c in common.columns if c.startswith("mark")]
        nodes, columns = nodes.join(common, "node"), [*columns, "bands", "common", *bits]
        entries = entries.join(common.select("node"), "node", "left_semi")
    sizes = entries.groupBy("key", "root").agg(F.count(F.lit(1)).alias("size")).groupBy("key")
    sizes = sizes.agg(F.max_by("root", F.struct("size", "root")).alias("main"), F.sum("size").alias("all"), F.max("size").alias("most")).where("most < all")
    slots = F.ceil(F.col("all") * (F.col("all") - F.col("most")).cast("double") / MEETINGS).cast("int").alias("slots")
    marked = entries.join(sizes.select("key", "main", slots), "key").join(nodes.select("node", *columns[2:]), "node")
    left = marked.where("root <> main").select("key", "main", F.pmod(F.xxhash64("node"), "slots").cast("int").alias("slot"), *[F.col(c).alias(f"a_{c}") for c in columns])
    right = marked.select("key", F.explode(F.sequence(F.lit(0), F.col("slots") - 1)).alias("slot"), *[F.col(c).alias(f"b_{c}") for c in columns])
    apart = (F.col("a_root") != F.col("b_root")) & ((F.col("b_root") == F.col("main")) | (F.col("a_node") < F.col("b_node")))
    sized = F.least("a_n", "b_n") >= F.greatest("a_n", "b_n") * similarity - 1e-9
    may_link = apart & sized & (_unlike(["bits0", "bits1"]) <= most_bits)
    if common is not None:
        # What a link has in common at least, and how unlike the common shingles of its texts then are at most.
        least = (F.col("a_n") + F.col("b_n")) * (similarity / (1 + similarity))
        apart_by = (1 - least / F.greatest(F.col("a_common") + F.col("b_common") - least, least)) / 2
        most = MARKS * apart_by + CHANCE / 3 + F.sqrt(CHANCE**2 / 9 + 2 * CHANCE * MARKS * apart_by * (1 - apart_by))  # Bernstein's bound
        once = F.array_min(F.array_intersect("a_bands", "b_bands")) == F.col("l.key")
        may_link = may_link & (F.least("a_common", "b_common") >= least - 1e-9) & (_unlike(bits) <= most) & once
    met = left.alias("l").join(right.alias("r"), (F.col("l.key") == F.col("r.key")) & (F.col("l.slot") == F.col("r.slot")) & may_link)
    return met.select(F.col("a_node").alias("a"), F.col("b_node").alias("b"), "a_root", "b_root", _unlike(bits or ["bits0", "bits1"]).alias("unlike"))


def _nearest(apart: DataFrame) -> DataFrame:
    """Of the pairs (a, b, a_root, b_root, unlike) the likeliest between each two classes."""
    classes = apart.groupBy(F.least("a_root", "b_root").alias("one"), F.greatest("a_root", "b_root").alias("other"))
    return classes.agg(F.min_by(F.struct("a", "b"), F.struct("unlike", "a", "b")).alias("pair")).select("pair.a", "pair.b")


def _still_apart(apart: DataFrame, roots: DataFrame | None) -> DataFrame:
    """Pairs (a, b) whose nodes are of different classes by ``roots`` (node, root)."""
    if roots is None:
        return apart.select("a", "b")
    for c in "ab":
        apart = apart.join(roots.select(F.col("node").alias(c), F.col("root").alias(f"{c}_now")), c, "left")
    return apart.where(F.coalesce("a_now", "a") != F.coalesce("b_now", "b")).select("a", "b")


def _unlike(columns: list[str]) -> Column:
    """In how many bits the columns of a and b differ."""
    return sum(F.bit_count(F.col(f"a_{c}").bitwiseXOR(F.col(f"b_{c}"))) for c in columns)


def _shared(keys: DataFrame, by: str = "node") -> DataFrame:
    """The rows of ``keys`` whose key several nodes (or what ``by`` names) have."""
    several = keys.groupBy("key").agg(F.min(by).alias("least"), F.max(by).alias("most")).where("least <> most").select("key")
    return keys.join(several, "key")


def _classes(nodes: DataFrame, docs: DataFrame, shingle: int, similarity: float, exact: bool, rounds: int) -> DataFrame:
    """(node, root) of the nodes that links join to others, roots aside."""
    spark, scratch = nodes.sparkSession, Scratch(nodes.sparkSession)
    fingerprints = scratch.stored(nodes.select("fingerprint").distinct(), "prints")
    near = components(links(fingerprints)).select(F.col("node").alias("fingerprint"), "root")
    by_class = nodes.join(near, "fingerprint", "left").select(F.coalesce("root", "fingerprint").alias("key"), "node")
    near = scratch.stored(_shared(by_class), "near")
    banded = scratch.stored(_shared(nodes.select("node", F.explode("bands").alias("key"))), "banded")
    wanted = nodes.join(near.select("node").union(banded.select("node")).distinct(), "node", "left_semi")
    wanted = wanted.select("node", F.col("doc_id").alias("own_id"), F.col("text_key").alias("own_key"))
    rows = docs.join(wanted, docs.doc_id.eqNullSafe(F.col("own_id")) & (text_key(F.col("text")) == F.col("own_key")))
    texts = scratch.stored(rows.groupBy("node").agg(F.first("text").alias("text")), "texts")
    found, roots, tried = None, None, None
    for step in range(2 + rounds + 2 * exact):
        if step > 2 + rounds:
            pairs = _still_apart(apart, roots)
        else:
            entries = (banded if step else near).withColumn("root", F.col("node"))
            if roots is not None:
                entries = entries.drop("root").join(roots, "node", "left").select("key", "node", F.coalesce("root", "node").alias("root"))
            if step == 2 + rounds:
                # One pair of each two classes comes first; what that joins needs no other.
                entries = scratch.stored(_shared(entries, "root"), "entries")
                common = scratch.stored(_common(entries, texts, shingle, similarity, scratch), "common")
                apart = scratch.stored(_all_pairs(entries, nodes, similarity, common), "apart")
                pairs = _nearest(apart)
            else:
                # A group of near copies finds together by one leader each, before all leaders of its bands are looked at.
                pairs = _with_one_leader(entries, step) if step < 2 else _with_leaders(entries, [step * LEADERS + i for i in range(LEADERS)])
        pairs = _ordered(pairs)
        pairs = pairs if tried is None else pairs.join(tried, ["a", "b"], "left_anti")
        # SimHash classes are compared as they are, and what leaves the last join has passed more than these estimates.
        alike = scratch.stored(_alike(pairs, nodes, similarity) if 0 < step < 2 + rounds else pairs, "alike")
        tried = alike if tried is None else tried.union(alike)
        good = scratch.stored(_verified(alike, texts, shingle, similarity), "likes")
        found = good if found is None else found.union(good)
        if not good.isEmpty():
            roots = components(found)
    roots = stored(components(found) if roots is None else roots, "roots")
    scratch.clear()
    return roots


def near_copies(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = SHINGLE,
    similarity: float = SIMILARITY,
    exact: bool = True,
    rounds: int = ROUNDS,
) -> DataFrame:
    """One row per document: doc_id, text_key, and the number of its group.

    Two texts link if their sets of ``shingle``-word shingles have a Jaccard
    likeness of ``similarity`` or more (fewer words are one shingle); groups are what links connect. No pair below it is
    linked. All links that share a band are found (a pair of 0.8 shares none of 32 with a chance of 5e-8), those that large groups
    of near copies need not have aside; ``exact=False`` finds most of them, by leaders alone. Texts without a word (null, empty, white space) are one
    group. Copies and repeated rows are compared once and each has a row; rows without an id are grouped like others. An
    empty table gives an empty table. Other columns of ``docs`` play no part.
    """
    scratch = Scratch(docs.sparkSession)
    marked = scratch.stored(_marks(docs, id_col, text_col, shingle), "marks")
    first = [F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_key")).alias("first")]
    first += [F.min("fingerprint").alias("fingerprint"), F.min("n").alias("n"), *[F.first(c).alias(c) for c in ("bands", "minima", "bits0", "bits1")]]
    nodes = marked.groupBy("node").agg(*first).select("node", "first.doc_id", "first.text_key", "fingerprint", "n", "bands", "minima", "bits0", "bits1")
    nodes = stored(nodes, "nodes")
    marked = stored(marked.select("doc_id", "text_key", "node"), "placed")
    scratch.clear()  # bands and minima are in nodes
    roots = _classes(nodes, keyed(docs, id_col, text_col), shingle, similarity, exact, rounds)
    placed = marked.join(roots, "node", "left")
    return placed.select("doc_id", "text_key", F.coalesce("root", "node").alias("group"))
