"""Local collections."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, types as T


def local_rows(spark: SparkSession, rows: Iterable[tuple], schema: T.StructType | str) -> DataFrame:
    """A small local collection as a DataFrame with an explicit schema."""
    return spark.createDataFrame(list(rows), schema)
