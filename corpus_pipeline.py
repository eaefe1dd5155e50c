"""From documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and works on all that the one before kept.
All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from panelkiln.llm import mixing, packing, quality, secrets
from panelkiln.llm.common import text_key
from panelkiln.llm.minhash import near_copies
from panelkiln.session import stored


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and keep enough of their words, without lines that too many of their host share."""
    return quality.filtered(docs)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the row of the smallest id; of equal rows one.

    Near copies are texts whose sets of 5-word shingles have a Jaccard likeness of 0.8 or more, and what such links
    connect; SimHash classes are compared first, then all that shares a MinHash band and is still apart (``minhash.near_copies``). Where rows
    of one id have several texts, the smallest text hash decides; of rows equal in id and text that of the least source
    and language stays. A group without any id keeps one of its rows; texts without a word (null, empty) are one group.
    """
    groups = near_copies(docs)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_key"))
    kept = groups.groupBy("group").agg(first.alias("k")).select(F.col("k.doc_id").alias("k_id"), F.col("k.text_key").alias("k_key"))
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    rows = docs.select(row.alias("row"), F.col("doc_id").alias("own_id"), text_key(F.col("text")).alias("own_key"))
    rows = rows.groupBy("own_id", "own_key").agg(F.min_by("row", F.struct("row.source", "row.lang")).alias("row"))
    rows = rows.join(kept, F.col("own_id").eqNullSafe(F.col("k_id")) & (F.col("own_key") == F.col("k_key")), "left_semi")
    return rows.select("row.*")


def secret_masks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The same documents, secrets in their texts replaced."""
    return secrets.masked(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, with quality labels as weights."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return mixing.mixed_documents(docs, mixing.label_weights(labels))


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of at most 4096 ids."""
    pieces = packing.pack(docs.select("doc_id", "text"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("simhash_dedup", simhash_dedup),
    ("secret_masks", secret_masks),
    ("source_mix", source_mix),
    ("packed_sequences", packed_sequences),
]

#: SQL has no tokenizer; the stages are tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each stage's rows stored and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
