"""File sinks (SK1, SK6)."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _norm(p: str) -> str:
    return re.sub(r"^file:/+", "/", p).rstrip("/")


def overlap(a: str, b: str) -> bool:
    """Whether one folder equals, holds or lies in the other."""
    a, b = _norm(a) + "/", _norm(b) + "/"
    return a.startswith(b) or b.startswith(a)


def guard_partition_values(df: DataFrame, cols: list[str] | None) -> DataFrame:
    """Fail the write on an empty-string partition value.

    Parquet folders store ``''`` like null (the default partition), so the
    value would silently read back as null. The check is an expression
    evaluated while the rows are written: no extra pass over the data.
    Null values are accepted."""
    if not cols:
        return df
    types = dict(df.dtypes)
    out = []
    for c in df.columns:
        if c in cols and types[c] == "string":
            out.append(
                F.when(F.col(c) == "", F.raise_error(F.lit(f"empty string in partition column {c}")))
                .otherwise(F.col(c))
                .alias(c)
            )
        else:
            out.append(F.col(c))
    return df.select(*out)


def cluster_by(df: DataFrame, cols: list[str] | None) -> DataFrame:
    """Cluster rows by the output partition columns before a partitioned
    write, so each task writes few partition folders (not every task every
    folder). A rebalance (not a plain hash repartition) lets adaptive
    execution split a partition value that holds a large share of the rows
    into several tasks instead of one."""
    if not cols:
        return df
    return df.hint("rebalance", *cols)


def write_parquet_overwrite(df: DataFrame, path: str, input_paths=()) -> str:
    """SK1: replace a Parquet folder. Refuses to overwrite one of its own
    inputs, or a folder that holds or lies in one (the job would delete
    what it is still reading). Zstandard, as for the loads below."""
    if any(overlap(path, p) for p in input_paths):
        raise ValueError(f"output path {path} overlaps an input")
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return path


def append_partitioned(df: DataFrame, path: str, partition_by: list[str], fmt: str = "parquet") -> str:
    """SK6: append files under ``col=value`` folders (never rewrites)."""
    df = guard_partition_values(df, partition_by)
    cluster_by(df, partition_by).write.mode("append").format(fmt).partitionBy(*partition_by).save(path)
    return path


def write_partitioned(df: DataFrame, path: str, partition_by: list[str], clustered: bool = False) -> str:
    """The rows as ``col=value`` folders of ``path``, in place of what an
    earlier attempt left there. Zstandard: article texts take a good deal less
    than with the default codec, and each load and compaction writes them.
    ``clustered``: the rows of a folder are in few tasks already."""
    df = guard_partition_values(df, partition_by)
    writer = cluster_by(df, [] if clustered else partition_by).write.mode("overwrite").option("partitionOverwriteMode", "static").option("compression", "zstd")
    writer.partitionBy(*partition_by).parquet(path)
    return path
