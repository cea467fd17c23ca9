"""Parquet source (SC2)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def read_parquet(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """SC2: Parquet with an optional explicit (possibly pruned) schema.

    A pruned nested schema is the user-level way to keep unused struct
    fields of exploded arrays out of the scan."""
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(path)
