"""Location ELT jobs (FI3, TR5, TR6, TR13)."""

from __future__ import annotations

import datetime as _dt
import logging

from pyspark.sql import DataFrame, SparkSession

from geonest import constants as K
from geonest import schemas as S
from geonest.operators.enrich import transform_countries
from geonest.operators.flatten import flatten_cities, flatten_states
from geonest.plans.validate import validation_checks
from geonest.sinks.catalog import write_table
from geonest.sinks.files import write_parquet_overwrite
from geonest.sources.json import read_json_lines, read_multiline_json, undeclared_schema
from geonest.sources.json_ranges import read_json_ranges
from geonest.sources.parquet import read_parquet

log = logging.getLogger(__name__)

KEYS = {"countries": ["country_id"], "states": ["state_id"], "cities": ["city_id"]}


def new_run_ts() -> str:
    """One load time per run, taken once on the driver, so every table of
    the run and every task retry carries the same stamp."""
    return _dt.datetime.now(_dt.timezone.utc).strftime("%Y-%m-%d %H:%M:%S.%f")


def convert_json_to_parquet(
    spark: SparkSession, raw_data_path: str, preprocess_data_path: str, schema=None, mode: str = "FAILFAST",
    lines: bool = False, declared_only: bool = False, split_files: bool = False,
) -> str:
    """TR5: JSON documents to Parquet (full replace). Errors propagate, so
    later steps never run on stale output.

    ``schema`` gives declared fields their types; fields it does not declare
    are kept with inferred types (one more pass over the input), unless
    ``declared_only``. ``lines``: one document per line, which Spark can
    split, instead of whole-file JSON. ``split_files``: whole-file JSON whose
    files are large, read by splits; needs a schema and keeps declared fields
    only."""
    if split_files:
        if schema is None or lines:
            raise ValueError("split_files needs a schema and whole-file JSON")
        write_parquet_overwrite(read_json_ranges(spark, raw_data_path, schema, mode), preprocess_data_path, input_paths=[raw_data_path])
        return preprocess_data_path
    if schema is not None and not declared_only:
        schema = undeclared_schema(spark, raw_data_path, schema, multiline=not lines)
    df = (read_json_lines if lines else read_multiline_json)(spark, raw_data_path, schema, mode)
    write_parquet_overwrite(df, preprocess_data_path, input_paths=[raw_data_path])
    log.info("converted %s to %s", raw_data_path, preprocess_data_path)
    return preprocess_data_path


def dataset_frames(
    dataset: str, docs: DataFrame, population: DataFrame | None, run_ts
) -> list[tuple[str, DataFrame, list[str]]]:
    """FI3: the (table, frame, partition columns) a dataset name produces.

    ``states`` / ``cities`` use inner explode, ``states_cities`` outer
    explode (the two row sets differ, as in the original jobs)."""
    if dataset == "countries":
        if population is None:
            raise ValueError("countries needs population data")
        return [("countries", transform_countries(docs, population, run_ts), S.PARTITIONING["countries"])]
    if dataset == "states":
        return [("states", flatten_states(docs, outer=False, run_ts=run_ts), S.PARTITIONING["states"])]
    if dataset == "cities":
        return [("cities", flatten_cities(docs, outer=False, run_ts=run_ts), S.PARTITIONING["cities"])]
    if dataset == "states_cities":
        return [
            ("states", flatten_states(docs, outer=True, run_ts=run_ts), S.PARTITIONING["states"]),
            ("cities", flatten_cities(docs, outer=True, run_ts=run_ts), S.PARTITIONING["cities"]),
        ]
    raise ValueError(f"unknown dataset {dataset!r}; expected one of {K.DATASETS}")


def run_elt(
    spark: SparkSession,
    dataset: str,
    preprocess_data_path: str,
    population_data_path: str | None = None,
    location: str | None = None,
    database: str = K.DEFAULT_DATABASE,
    catalog: str | None = None,
    run_ts=None,
    partition_by: dict[str, list[str]] | None = None,
    replace: str = "full",
) -> DataFrame:
    """TR6: read preprocessed documents, transform ``dataset``, replace its
    table(s), and return the validation checks of what was written.
    ``partition_by`` (by table) and ``replace`` are passed to the sink."""
    run_ts = run_ts or new_run_ts()
    docs = read_parquet(spark, preprocess_data_path, S.COUNTRY)
    population = (
        read_parquet(spark, population_data_path, S.POPULATION) if population_data_path else None
    )
    checks = None
    for table, frame, parts in dataset_frames(dataset, docs, population, run_ts):
        parts = (partition_by or {}).get(table, parts)
        S.assert_contract(frame, table)
        path = f"{location.rstrip('/')}/{table}" if location else None
        inputs = [p for p in (preprocess_data_path, population_data_path) if p]
        name = write_table(frame, table, database, catalog, path, parts, replace=replace, input_paths=inputs)
        written = spark.table(name)
        c = validation_checks(written, table, KEYS[table])
        checks = c if checks is None else checks.unionByName(c)
    return checks


def run_location_pipeline(
    spark: SparkSession,
    raw_locations_path: str,
    raw_population_path: str,
    work_dir: str,
    database: str = K.DEFAULT_DATABASE,
    catalog: str | None = None,
    run_ts=None,
) -> DataFrame:
    """TR13: convert locations, convert population, countries, then states
    and cities; stops at the first error. The converted Parquet is the
    lineage cut between steps (written in ``work_dir``, a shared folder)."""
    run_ts = run_ts or new_run_ts()
    work_dir = work_dir.rstrip("/")
    locations = convert_json_to_parquet(spark, raw_locations_path, f"{work_dir}/preprocessed/locations", S.COUNTRY)
    population = convert_json_to_parquet(
        spark, raw_population_path, f"{work_dir}/preprocessed/population", S.POPULATION
    )
    target = f"{work_dir}/tables"
    a = run_elt(spark, "countries", locations, population, target, database, catalog, run_ts)
    b = run_elt(spark, "states_cities", locations, None, target, database, catalog, run_ts)
    return a.unionByName(b)
