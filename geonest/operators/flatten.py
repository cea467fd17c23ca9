"""Nested country -> state -> city flattening (GE1-GE4, TR2-TR4).

``outer=False`` drops parents whose child array is null or empty (explode);
``outer=True`` keeps them as one row with null child columns
(explode_outer). The single-dataset jobs use inner semantics, the combined
job uses outer semantics, so the two produce different row sets.

All operators here are narrow: generate + project inside one codegen stage,
no shuffle, so they scale with the number of input files.

Nested pruning: Catalyst does not prune unused struct fields of an array
that is exploded whole, so exploding ``states`` would read every city of
every state even when only state scalars are needed. The state-level
operators therefore explode a zip of only the state fields they use, which
keeps ``cities`` out of the Parquet ReadSchema.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geonest.functions.scalars import run_stamp, to_float

STATE_SCALARS = ["id", "name", "state_code", "latitude", "longitude"]


def _gen(outer: bool):
    return F.explode_outer if outer else F.explode


def explode_states(
    docs: DataFrame, fields: list[str] = STATE_SCALARS, outer: bool = False
) -> DataFrame:
    """One row per state with ``country_id``, ``country_code`` and a
    ``state`` struct holding only ``fields`` (GE1 / GE3)."""
    zipped = F.arrays_zip(*[F.col("states")[f].alias(f) for f in fields])
    return docs.select(
        F.col("id").alias("country_id"),
        F.col("iso3").alias("country_code"),
        _gen(outer)(zipped).alias("state"),
    )


def explode_cities(states: DataFrame, outer: bool = False) -> DataFrame:
    """One row per city of an exploded state frame (GE2 / GE4)."""
    return states.select(
        "country_id",
        "country_code",
        F.col("state.id").alias("state_id"),
        F.col("state.name").alias("state_name"),
        F.col("state.state_code").alias("state_code"),
        _gen(outer)("state.cities").alias("city"),
    )


def flatten_states(docs: DataFrame, outer: bool = False, run_ts=None) -> DataFrame:
    """TR2 (inner) / states half of TR4 (outer), in contract order."""
    stamp = run_stamp(run_ts)
    return explode_states(docs, STATE_SCALARS, outer).select(
        "country_id",
        "country_code",
        F.col("state.id").alias("state_id"),
        F.col("state.name").alias("state_name"),
        F.col("state.state_code").alias("state_code"),
        to_float("state.latitude").alias("latitude"),
        to_float("state.longitude").alias("longitude"),
        stamp.alias("created_at"),
        stamp.alias("last_updated_at"),
    )


def flatten_cities(docs: DataFrame, outer: bool = False, run_ts=None) -> DataFrame:
    """TR3 (inner) / cities half of TR4 (outer), in contract order."""
    stamp = run_stamp(run_ts)
    states = explode_states(docs, ["id", "name", "state_code", "cities"], outer)
    return explode_cities(states, outer).select(
        "country_id",
        "country_code",
        "state_id",
        "state_name",
        "state_code",
        F.col("city.id").alias("city_id"),
        F.col("city.name").alias("city_name"),
        to_float("city.latitude").alias("latitude"),
        to_float("city.longitude").alias("longitude"),
        stamp.alias("created_at"),
        stamp.alias("last_updated_at"),
    )


def flatten_states_and_cities(
    docs: DataFrame, run_ts=None, outer: bool = True
) -> tuple[DataFrame, DataFrame]:
    """TR4: both tables of the combined job; defaults to outer semantics.

    The two plans are independent scans: the states scan reads no city
    column at all, so sharing (caching) the level-1 explode would cost more
    memory than the second, pruned scan costs I/O.
    """
    return (
        flatten_states(docs, outer=outer, run_ts=run_ts),
        flatten_cities(docs, outer=outer, run_ts=run_ts),
    )
