"""What several of the corpus operators need."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: A word is a maximal run of anything but space and \t \n \v \f \r. ``bytes.split()`` cuts UTF-8 the same way.
WORD = r"[^\x20\x09-\x0D]+"


def shuffle_parts(spark: SparkSession) -> int:
    """Number of shuffle partitions the session asks for; what is packed by hand is dealt to as many."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_key(text: Column) -> Column:
    """With the id, what tells a row from others: rows equal in both are copies and share one result."""
    return F.xxhash64(text)


def utf8(column: pa.Array) -> list[bytes | None]:
    """Strings of an Arrow column as UTF-8."""
    return column.cast(pa.binary()).to_pylist()


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Id and text alone, under names of our own, so that other columns can't clash."""
    return docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
