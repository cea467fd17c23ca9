"""Countries with population (JN1, PR1, PR6, TR1)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geonest import constants as K
from geonest.functions.scalars import run_stamp, source_timestamp, to_float


def transform_countries(
    docs: DataFrame,
    population: DataFrame,
    run_ts=None,
    population_updated_at: str = K.POPULATION_SOURCE_TIMESTAMP,
) -> DataFrame:
    """TR1: one row per country document, left-joined to population.

    Join semantics follow a SQL LEFT JOIN on ``iso3 = Alpha_3``: countries
    without a match keep a null population, null codes never match, and a
    duplicated ``Alpha_3`` repeats the country once per match (use
    ``geonest.plans.validate`` to flag such duplicates).

    A plain join: adaptive execution broadcasts the population side when
    its finished shuffle turns out small, and splits skewed countries when
    not.
    """
    stamp = run_stamp(run_ts)
    pop = population.select(
        F.col("Alpha_3").alias("_pop_code"), F.col("Population").alias("population")
    )
    countries = docs.select(
        F.col("id").alias("country_id"),
        F.col("name").alias("country_name"),
        F.col("iso3").alias("country_code"),
        "capital",
        "currency",
        "currency_name",
        "currency_symbol",
        "region",
        "subregion",
        "phone_code",
        "emoji",
        to_float("latitude").alias("latitude"),
        to_float("longitude").alias("longitude"),
    )
    joined = countries.join(pop, countries["country_code"] == pop["_pop_code"], "left")
    return joined.select(
        *countries.columns,
        "population",
        source_timestamp(population_updated_at).alias("population_source_last_updated_at"),
        stamp.alias("created_at"),
        stamp.alias("last_updated_at"),
    )


_COUNTRIES_SQL = """
SELECT d.id AS country_id, d.name AS country_name, d.iso3 AS country_code, d.capital,
       d.currency, d.currency_name, d.currency_symbol, d.region, d.subregion, d.phone_code, d.emoji,
       try_cast(d.latitude AS FLOAT) AS latitude, try_cast(d.longitude AS FLOAT) AS longitude,
       p.Population AS population,
       to_timestamp(:source_ts) AS population_source_last_updated_at,
       {stamp} AS created_at, {stamp} AS last_updated_at
FROM {{docs}} d LEFT JOIN {{pop}} p ON d.iso3 = p.Alpha_3
"""


def transform_countries_sql(
    spark: SparkSession,
    docs: DataFrame,
    population: DataFrame,
    run_ts=None,
    population_updated_at: str = K.POPULATION_SOURCE_TIMESTAMP,
) -> DataFrame:
    """TR1 written as SQL over the two inputs, the form the original job
    uses (SC4). Same result and plan as ``transform_countries``.

    The frames are passed as SQL parameters rather than session-wide temp
    views, so concurrent callers cannot see or replace each other's
    inputs; literals are bound as named parameters.
    """
    stamp = "current_timestamp()" if run_ts is None else "CAST(:run_ts AS TIMESTAMP)"
    args = {"source_ts": population_updated_at}
    if run_ts is not None:
        args["run_ts"] = str(run_ts)
    query = _COUNTRIES_SQL.format(stamp=stamp)
    return spark.sql(query, args=args, docs=docs, pop=population)
