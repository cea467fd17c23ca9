"""Post-write validation (TR7): checks as data, not printed rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geonest.operators.preview import filter_equals, top_n


def validation_checks(df: DataFrame, table: str, keys: list[str]) -> DataFrame:
    """One row per check: ``(table_name, check_name, value)``.

    * ``row_count``
    * ``null_<key>``: rows with a null key column
    * ``duplicate_keys``: key values occurring more than once

    One scan: rows are counted per key value (map-side partial counts
    first, so a hot key collapses to one partial row per task before the
    shuffle; null keys form their own groups), and every check is a fold
    over those per-key counts.
    """
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    keyed = F.lit(True)
    for k in keys:
        keyed = keyed & F.col(k).isNotNull()
    names = ["row_count"] + [f"null_{k}" for k in keys] + ["duplicate_keys"]
    summary = per_key.agg(
        F.sum("_n").alias("row_count"),
        *[F.sum(F.when(F.col(k).isNull(), F.col("_n"))).alias(f"null_{k}") for k in keys],
        F.count_if(keyed & (F.col("_n") > 1)).alias("duplicate_keys"),
    )
    checks = F.array(
        *[
            F.struct(F.lit(n).alias("check_name"), F.coalesce(F.col(n).cast("long"), F.lit(0)).alias("value"))
            for n in names
        ]
    )
    return summary.select(F.explode(checks).alias("c")).select(
        F.lit(table).alias("table_name"), "c.check_name", "c.value"
    )


def reference_checks(child: DataFrame, parent: DataFrame, name: str, keys: list[str], parent_keys: list[str] | None = None) -> DataFrame:
    """TR7 across tables, one row per check: ``orphans`` (rows of ``child`` whose
    ``keys``, all present, no row of ``parent`` has) and ``unreferenced``
    (rows of ``parent`` whose keys no row of ``child`` has).

    Both sides are counted by key first, so a hot key is one row when the
    keys meet in one full join."""
    parent_keys = parent_keys or keys
    known = F.lit(True)
    for k in keys:
        known = known & F.col(k).isNotNull()

    def counts(df: DataFrame, columns: list[str], count: str) -> DataFrame:
        return df.select(*(F.col(c).alias(k) for c, k in zip(columns, keys, strict=True))).where(known).groupBy(*keys).agg(F.count(F.lit(1)).alias(count))

    both = counts(child, keys, "_children").join(counts(parent, parent_keys, "_parents"), keys, "full")
    found = both.agg(
        F.coalesce(F.sum(F.when(F.col("_parents").isNull(), F.col("_children"))), F.lit(0)).alias("orphans"),
        F.coalesce(F.sum(F.when(F.col("_children").isNull(), F.col("_parents"))), F.lit(0)).alias("unreferenced"),
    )
    checks = F.array(*(F.struct(F.lit(n).alias("check_name"), F.col(n).alias("value")) for n in ("orphans", "unreferenced")))
    return found.select(F.explode(checks).alias("c")).select(F.lit(name).alias("table_name"), "c.check_name", "c.value")


def location_reference_checks(countries: DataFrame, states: DataFrame, cities: DataFrame) -> DataFrame:
    """Cities against their states and states against their countries."""
    return reference_checks(cities, states, "cities", ["country_id", "state_id"]).unionByName(
        reference_checks(states, countries, "states", ["country_id"])
    )


def spot_check(df: DataFrame, column: str | None = None, value=None, n: int = 10, order_by=None) -> DataFrame:
    """The reference's sample queries: rows equal to a value, else ``n``
    rows (ordered when ``order_by`` is given)."""
    if column is not None:
        return filter_equals(df, column, value)
    return top_n(df, n, order_by)


def _quote(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def spot_check_sql(
    spark: SparkSession,
    table: str,
    column: str | None = None,
    value=None,
    n: int = 10,
    order_by: list[str] | None = None,
) -> DataFrame:
    """The original's post-write sample queries as SQL against the written
    table by its (up to three-part) catalog name (SC3): rows where
    ``column`` equals ``value``, else ``n`` rows (ordered by ``order_by``,
    nulls last, when given).

    The table name and the value are bound as parameters, never spliced
    into the text; the filter reaches the scan (and prunes partitions when
    ``column`` is a partition column)."""
    args = {"table": table}
    if column is not None:
        args.update(column=column, value=value)
        return spark.sql("SELECT * FROM IDENTIFIER(:table) WHERE IDENTIFIER(:column) = :value", args=args)
    args["n"] = n
    order = ""
    if order_by:
        order = " ORDER BY " + ", ".join(f"{_quote(c)} ASC NULLS LAST" for c in order_by)
    return spark.sql(f"SELECT * FROM IDENTIFIER(:table){order} LIMIT :n", args=args)
