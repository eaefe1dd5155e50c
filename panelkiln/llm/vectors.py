"""What the operators on vectors share: which rows take part, and their vectors as matrices."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F


def _finite(vector: Column) -> Column:
    big = F.lit(float("inf")).cast("double")
    return F.forall(vector, lambda c: F.coalesce(F.abs(c.cast("double")) < big, F.lit(False)))


def usable(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, vec) of rows whose vector is there and holds finite numbers only.

    One table has vectors of one length: the most frequent one, the longer of two
    as frequent. Rows of other lengths, and empty vectors, take no part. Other
    columns of ``rows`` are left out, so that their names can't clash.
    """
    found = rows.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), F.col(f"`{vector_col}`").alias("vec"))
    found = found.where(F.col("vec").isNotNull() & (F.size("vec") > 0) & _finite(F.col("vec")))
    lengths = found.groupBy(F.size("vec").alias("length")).agg(F.count(F.lit(1)).alias("n"))
    length = lengths.agg(F.max_by("length", F.struct("n", "length"))).first()[0]
    return found.where(F.size("vec") == F.lit(length or 0))


def matrix(column: pa.Array) -> np.ndarray:
    """Lists of one length as rows of doubles."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)
