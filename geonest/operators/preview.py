"""Spot-check operators of the post-write validation (FI1, LI1, PR4)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def filter_equals(df: DataFrame, column: str, value) -> DataFrame:
    """FI1: rows whose ``column`` equals ``value`` (null never matches).

    A plain comparison, so it reaches the Parquet scan as a pushed filter
    and prunes partitions when ``column`` is a partition column."""
    return df.filter(F.col(column) == F.lit(value))


def top_n(df: DataFrame, n: int = 10, order_by: list[str] | None = None) -> DataFrame:
    """LI1: the first ``n`` rows by ``order_by`` (deterministic; without an
    order it is any ``n`` rows, as a bare LIMIT)."""
    if order_by:
        df = df.orderBy(*order_by)
    return df.limit(n)
