"""Parquet tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType


def read_table(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def optional_table(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """The table at ``path``, or an empty one of the same shape when there is none."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def with_month(df: DataFrame, on: str = "date") -> DataFrame:
    """``month`` as yyyyMM: the partition column of stored panels."""
    return df.withColumn("month", F.date_format(on, "yyyyMM").cast("int"))


def write_table(
    df: DataFrame, path: str, *, partition_by: str | None = None, sort_by: Sequence[str] = (), mode: str = "overwrite"
) -> None:
    """Write Parquet in evenly sized files.

    The rebalance hint gives each partition value few files, yet lets adaptive
    execution split a value that holds much of the table. Rows are sorted inside
    each file, which serves row-group pruning without a global sort.
    """
    out = df.hint("rebalance", partition_by) if partition_by else df.hint("rebalance")
    if sort_by:
        keys = ([partition_by] if partition_by else []) + list(sort_by)
        out = out.sortWithinPartitions(*keys)
    writer = out.write.mode(mode)
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)
