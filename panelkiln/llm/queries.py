"""Registered queries of the corpus operators, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

import corpus_pipeline
from panelkiln.llm import alignment, debruijn, forest, licenses, mixing, quality, suffixes, warc, whitening
from panelkiln.llm.multiset import edit_study
from panelkiln.llm.packing import pack
from panelkiln.llm.secrets import secret_spans
from panelkiln.llm.simhash import near_duplicates
from panelkiln.session import fresh_folder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(function: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[function.__name__] = function
    return function


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@_query
def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_documents(spark, sf_dir)).select("doc_id", "fingerprint", "component_id")


@_query
def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = pack(_documents(spark, sf_dir).select("doc_id", "text"))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


@_query
def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    mixed = mixing.mix(_documents(spark, sf_dir), mixing.label_weights(labels))
    return mixed.select("doc_id", "size", "source_size", F.round("target", 3).alias("target"), "taken")


ORACLES["op9_mixing"] = mixing.SQL


def _of_kinds(*kinds: str) -> Column:
    return F.filter("spans", lambda s: s.kind.isin(*kinds))


def _span_line(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.first, s.stop)), ",")


@_query
def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = ("assign", "access", "hex")
    return secret_spans(_documents(spark, sf_dir)).select(
        "doc_id",
        *[F.size(_of_kinds(kind)).cast("long").alias(f"n_{kind}") for kind in base],
        F.sha2(_span_line(_of_kinds(*base)), 256).alias("base_sha256"),
        _span_line(F.col("spans")).alias("spans"),
    )


@_query
def op6_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edit_study(_documents(spark, sf_dir)).select(
        "doc_id",
        "n_chars",
        F.sha2("edited_text", 256).alias("edited_sha256"),
        "fingerprint",
        "edited_fingerprint",
        "near_edited",
        "near_next",
    )


@_query
def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = fresh_folder(spark, "warc")
    warc.write_archives(spark.read.parquet(f"{sf_dir}/pages.parquet"), folder)
    return warc.read_archives(spark, folder).drop("url", "payload")


ORACLES["op7_warc"] = warc.SQL


@_query
def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judged(_documents(spark, sf_dir)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "n_line_words", "kept"
    )


ORACLES["op5_quality"] = quality.SQL


@_query
def op2_debruijn(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = debruijn.without_repeats(_documents(spark, sf_dir))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


ORACLES["op2_debruijn"] = debruijn.SQL


@_query
def op3_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.without_repeats(_documents(spark, sf_dir)).select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.length("kept")).cast("long").alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


@_query
def op4_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(_documents(spark, sf_dir)).drop("text_key")


ORACLES["op4_licenses"] = licenses.SQL


@_query
def op11_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return forest.nearest(rows, rows.where("vec_id % 50 = 0"))


@_query
def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = whitening.whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    return found.withColumn("deviation", F.col("deviation").try_cast("long"))


@_query
def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(_documents(spark, sf_dir))


@_query
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)
