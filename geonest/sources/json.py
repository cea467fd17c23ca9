"""JSON sources (SC1)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def with_undeclared(declared: T.DataType, found: T.DataType) -> T.DataType:
    """``declared`` with the fields that only ``found`` (an inferred type) has
    added after it, at every level of structs and arrays; declared types win."""
    if isinstance(declared, T.StructType) and isinstance(found, T.StructType):
        seen = {f.name: f.dataType for f in found.fields}
        own = [T.StructField(f.name, with_undeclared(f.dataType, seen[f.name]) if f.name in seen else f.dataType) for f in declared.fields]
        return T.StructType(own + [f for f in found.fields if f.name not in declared.names])
    if isinstance(declared, T.ArrayType) and isinstance(found, T.ArrayType):
        return T.ArrayType(with_undeclared(declared.elementType, found.elementType))
    return declared


def undeclared_schema(spark: SparkSession, path: str, schema: T.StructType, multiline: bool = True) -> T.StructType:
    """``schema`` extended by the fields of the input that it does not declare
    (one inference pass)."""
    return with_undeclared(schema, spark.read.option("multiLine", multiline).json(path).schema)


def read_multiline_json(
    spark: SparkSession, path: str, schema: T.StructType | None = None, mode: str = "FAILFAST"
) -> DataFrame:
    """SC1: whole-file JSON (one array or object per file).

    A multi-line file cannot be split, so parallelism is the number of
    files: pass a directory of many files for large inputs. With a schema
    no inference pass runs; FAILFAST raises on a corrupt file instead of
    yielding a lone ``_corrupt_record`` column.
    """
    reader = spark.read.option("multiLine", True).option("mode", mode)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.json(path)


def read_json_lines(
    spark: SparkSession, path: str, schema: T.StructType | None = None, mode: str = "FAILFAST"
) -> DataFrame:
    """Line-delimited JSON: splittable, the scalable form of SC1."""
    reader = spark.read.option("mode", mode)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.json(path)
