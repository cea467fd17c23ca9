"""Catalog sources (SC3, SC4)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def qualified_name(table: str, database: str | None = None, catalog: str | None = None) -> str:
    return ".".join(p for p in (catalog, database, table) if p)


def read_table(
    spark: SparkSession, table: str, database: str | None = None, catalog: str | None = None
) -> DataFrame:
    """SC3: a catalog table by (up to) three-part name."""
    return spark.table(qualified_name(table, database, catalog))


def register_view(df: DataFrame, name: str) -> DataFrame:
    """SC4: name a DataFrame for SQL, replacing an existing view."""
    df.createOrReplaceTempView(name)
    return df


def sql_on(spark: SparkSession, query: str, **frames: DataFrame) -> DataFrame:
    """Run SQL over DataFrames passed as parameters (``{name}`` in the
    text), so no session-wide view name leaks between callers."""
    return spark.sql(query, **frames)
