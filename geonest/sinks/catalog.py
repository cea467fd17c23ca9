"""Catalog table sink (SK2-SK5): full replacement of a table."""

from __future__ import annotations

import threading
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geonest import constants as K
from geonest.sinks.files import cluster_by, guard_partition_values, overlap
from geonest.sources.catalog import qualified_name

SESSION_CATALOG = "spark_catalog"
_OVERWRITE_MODE = "spark.sql.sources.partitionOverwriteMode"
_DYNAMIC = threading.Lock()


def write_table(
    df: DataFrame,
    table: str,
    database: str = K.DEFAULT_DATABASE,
    catalog: str | None = None,
    path: str | None = None,
    partition_by: list[str] | None = None,
    fmt: str = "parquet",
    table_properties: dict[str, str] | None = None,
    replace: str = "full",
    run_id: str | None = None,
    input_paths=(),
) -> str:
    """Create or fully replace ``catalog.database.table`` from ``df``.

    * ``partition_by``: identity partition columns; None/empty = none (SK3).
    * ``fmt`` / ``table_properties``: provider and properties (SK4).
    * ``path``: explicit table location (SK5); keep it stable across runs.
      On the session catalog each run's files are in a folder under it.

    A named (V2) catalog gets an atomic ``createOrReplace``. The built-in
    session catalog cannot replace a file-source table that way: the rows
    are written as a staged table in a fresh folder ``<path>/run-<id>`` (of
    the database's folder without ``path``), and only when that has
    succeeded does the name change over. A failed write leaves the old
    table as it was; folders of earlier runs stay for the caller to retire.
    ``input_paths`` names folders the job reads: a location that equals,
    holds or lies in one of them is refused before anything is written.

    Parquet folders cannot hold an empty-string partition value, so on the
    session catalog such a value fails the write; a V2 catalog stores it.

    ``replace="partitions"`` refreshes only the partitions present in
    ``df`` (dynamic partition overwrite) when the table already exists;
    other partitions keep their rows.

    ``replace="swap"`` writes a new per-run table ``<table>__<run>`` and then
    points the view ``<table>`` at it; an earlier table of that name is
    kept as ``<table>__before_<run>``. Filters on partition columns still
    prune through the view. Earlier run tables are left in place for the
    caller to retire.
    """
    if replace not in ("full", "partitions", "swap"):
        raise ValueError(f"replace must be 'full', 'partitions' or 'swap', not {replace!r}")
    if path and any(overlap(path, p) for p in input_paths):
        raise ValueError(f"table location {path} overlaps an input")
    spark = df.sparkSession
    run = run_id or uuid.uuid4().hex[:12]
    v2 = bool(catalog and catalog != SESSION_CATALOG)
    name = qualified_name(table, database, catalog)
    if database:
        spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {qualified_name(database, None, catalog)}")
    if replace == "swap":
        physical = write_table(df, f"{table}__{run}", database, catalog, path, partition_by, fmt, table_properties)
        if spark.catalog.tableExists(name) and not _is_view(spark, name):
            spark.sql(f"ALTER TABLE {name} RENAME TO {qualified_name(f'{table}__before_{run}', database, None if not v2 else catalog)}")
        spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM {physical}")
        return physical
    if v2:
        df = cluster_by(df, partition_by)
        if replace == "partitions" and partition_by and spark.catalog.tableExists(name):
            df.writeTo(name).overwritePartitions()
            return name
        w = df.writeTo(name).using(fmt)
        if path:
            w = w.option("path", path)
        for k, v in (table_properties or {}).items():
            w = w.tableProperty(k, v)
        if partition_by:
            w = w.partitionedBy(*[F.col(c) for c in partition_by])
        w.createOrReplace()
        return name
    df = cluster_by(guard_partition_values(df, partition_by), partition_by)
    if replace == "partitions" and partition_by and spark.catalog.tableExists(name):
        # insertInto is positional: follow the table's column order. A catalog
        # insert takes the overwrite mode from the session alone; the lock
        # keeps two such writers of this process from mixing up the setting,
        # and no other write here overwrites.
        with _DYNAMIC:
            before = spark.conf.get(_OVERWRITE_MODE)
            spark.conf.set(_OVERWRITE_MODE, "dynamic")
            try:
                df.select(*spark.table(name).columns).write.insertInto(name, overwrite=True)
            finally:
                spark.conf.set(_OVERWRITE_MODE, before)
        return name
    base = path or f"{_database_location(spark, database)}/{table}"
    staged = qualified_name(f"{table}__staged_{run}", database, catalog)

    def writer(frame: DataFrame):
        w = frame.write.format(fmt).option("path", f"{base.rstrip('/')}/run-{run}")
        for k, v in (table_properties or {}).items():
            w = w.option(k, v)
        return w.partitionBy(*partition_by) if partition_by else w

    try:
        if partition_by:
            # An empty table first, then the rows: the insert registers exactly
            # the partitions its write job produced; a create-as-select would
            # rediscover them by listing the whole folder afterwards.
            writer(df.limit(0)).saveAsTable(staged)
            df.select(*spark.table(staged).columns).write.insertInto(staged)
        else:
            writer(df).saveAsTable(staged)
    except Exception:
        spark.sql(f"DROP TABLE IF EXISTS {staged}")
        raise
    _publish(spark, staged, name, qualified_name(f"{table}__before_{run}", database))
    return name


def _publish(spark: SparkSession, staged: str, name: str, before: str) -> None:
    """Give ``staged`` the name; what had it before goes, unless that fails."""
    target = name.split(".", 1)[1] if name.startswith(f"{SESSION_CATALOG}.") else name
    if not spark.catalog.tableExists(name):
        spark.sql(f"ALTER TABLE {staged} RENAME TO {target}")
    elif _is_view(spark, name):
        spark.sql(f"DROP VIEW {name}")
        spark.sql(f"ALTER TABLE {staged} RENAME TO {target}")
    else:
        spark.sql(f"ALTER TABLE {name} RENAME TO {before}")
        try:
            spark.sql(f"ALTER TABLE {staged} RENAME TO {target}")
        except Exception:
            spark.sql(f"ALTER TABLE {before} RENAME TO {target}")
            raise
        spark.sql(f"DROP TABLE {before}")


def _is_view(spark: SparkSession, name: str) -> bool:
    return spark.catalog.getTable(name).tableType == "VIEW"


def _database_location(spark: SparkSession, database: str | None) -> str:
    return spark.catalog.getDatabase(database or spark.catalog.currentDatabase()).locationUri.rstrip("/")


def read_contract(df: DataFrame, columns: list[str]) -> DataFrame:
    """Restore contract column order (partition columns are stored last)."""
    return df.select(*columns)
