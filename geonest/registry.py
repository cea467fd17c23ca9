"""Registered queries (Spark) and their DuckDB oracle SQL.

Every query reads the driver tables (or data Spark derives from them) in
full. Results are made engine-neutral before comparison: 32-bit floats are
widened to double and timestamps become timestamp_ntz.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from geonest import constants as K
from geonest import fixtures as FX
from geonest import schemas as S
from geonest.operators.enrich import transform_countries, transform_countries_sql
from geonest.operators.flatten import flatten_cities, flatten_states
from geonest.operators.news import classify_responses, parse_responses
from geonest.operators.preview import filter_equals, top_n
from geonest.operators.requests import build_requests, coverage_gaps, request_grid, sample_by_need, sample_requests
from geonest.plans.location import convert_json_to_parquet, run_elt, run_location_pipeline
from geonest.plans.news import compact_news, load_news, news_articles
from geonest.plans.validate import location_reference_checks, spot_check_sql, validation_checks
from geonest.session import new_scratch_dir
from geonest.sinks.catalog import read_contract, write_table
from geonest.sources.json_ranges import read_location_pieces
from geonest.sources.news import read_news_layout, read_news_rejects, read_news_table, read_response_log
from geonest.sources.reference import country_codes
from geonest.streaming.news_stream import run_news_stream_once

RUN_TS = FX.FIXED_RUN_TS
SCRATCH_DB = "geonest_scratch"
RAW_CODEC = "lz4"


def comparable(df: DataFrame) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.FloatType):
            c = c.cast("double")
        elif isinstance(f.dataType, T.TimestampType):
            c = c.cast("timestamp_ntz")
        cols.append(c.alias(f.name))
    return df.select(*cols)


# --- location queries --------------------------------------------------------


def q_cities_outer(spark, sf):
    return comparable(flatten_cities(FX.location_docs(spark, sf), outer=True, run_ts=RUN_TS))


def q_cities_inner(spark, sf):
    return comparable(flatten_cities(FX.location_docs(spark, sf), outer=False, run_ts=RUN_TS))


def q_states_outer(spark, sf):
    return comparable(flatten_states(FX.location_docs(spark, sf), outer=True, run_ts=RUN_TS))


def q_states_inner(spark, sf):
    return comparable(flatten_states(FX.location_docs(spark, sf), outer=False, run_ts=RUN_TS))


STAMP_TS = "2025-06-30 23:59:59.123456"


def q_stamped_states(spark, sf):
    """FN3: one literal load time on every row of a run (microseconds kept)."""
    states = flatten_states(FX.location_docs(spark, sf), outer=True, run_ts=STAMP_TS)
    return comparable(states.select("country_id", "state_id", "created_at", "last_updated_at"))


def q_countries(spark, sf):
    docs = FX.location_docs(spark, sf)
    return comparable(transform_countries(docs, FX.population_frame(spark, sf), run_ts=RUN_TS))


def q_countries_sql(spark, sf):
    """TR1 in its SQL form (SC4): same rows as ``countries``."""
    docs = FX.location_docs(spark, sf)
    return comparable(transform_countries_sql(spark, docs, FX.population_frame(spark, sf), run_ts=RUN_TS))


def _scratch_table(spark, frame: DataFrame, table: str, parts: list[str]) -> DataFrame:
    """Write ``frame`` as a table located in a fresh shared scratch folder
    and read it back in contract order."""
    loc = new_scratch_dir(spark, f"table-{table}")
    name = f"{table}_{loc.rsplit('-', 1)[-1]}"
    write_table(frame, name, SCRATCH_DB, path=loc, partition_by=parts)
    return read_contract(spark.table(f"{SCRATCH_DB}.{name}"), S.CONTRACTS[table]), name


def q_filter_eq(spark, sf):
    states = flatten_states(FX.location_docs(spark, sf), outer=True, run_ts=RUN_TS)
    written, _ = _scratch_table(spark, states, "states", S.PARTITIONING["states"])
    return comparable(filter_equals(written, "state_name", "1-URGENT"))


def q_top10(spark, sf):
    countries = transform_countries(FX.location_docs(spark, sf), FX.population_frame(spark, sf), run_ts=RUN_TS)
    written, _ = _scratch_table(spark, countries, "countries", S.PARTITIONING["countries"])
    return comparable(top_n(written, 10, ["country_id"]))


def _raw_json(spark, sf) -> tuple[str, str]:
    """The raw multi-line JSON landings (location documents, population),
    written once per process: input data, like the nested fixture. Their
    readers take each file whole, so the files are compressed."""
    key = ("raw-json", sf)
    if key not in FX._materialised:
        FX._materialised[key] = (
            FX.write_multiline_json(FX.location_docs(spark, sf), new_scratch_dir(spark, "raw-locations"), compression=RAW_CODEC),
            FX.write_multiline_json(FX.population_frame(spark, sf), new_scratch_dir(spark, "raw-population"), compression=RAW_CODEC),
        )
    return FX._materialised[key]


def _raw_ranges(spark, sf) -> str:
    """The raw location documents as plain text, which can be read by splits."""
    key = ("raw-ranges", sf)
    if key not in FX._materialised:
        FX._materialised[key] = FX.write_multiline_json(FX.location_docs(spark, sf), new_scratch_dir(spark, "raw-ranges"))
    return FX._materialised[key]


def q_json_to_parquet(spark, sf):
    raw = _raw_json(spark, sf)[0]
    out = new_scratch_dir(spark, "preprocessed-locations")
    convert_json_to_parquet(spark, raw, out, S.COUNTRY)
    docs = spark.read.schema(S.COUNTRY).parquet(out)
    return comparable(flatten_cities(docs, outer=True, run_ts=RUN_TS))


def q_json_ranges_convert(spark, sf):
    """SC1, TR5 with files read by splits."""
    raw = _raw_ranges(spark, sf)
    out = new_scratch_dir(spark, "preprocessed-ranges")
    convert_json_to_parquet(spark, raw, out, S.COUNTRY, split_files=True)
    return comparable(flatten_cities(spark.read.schema(S.COUNTRY).parquet(out), outer=True, run_ts=RUN_TS))


def _giant(spark, sf, table):
    key = ("nation-documents", sf)
    if key not in FX._materialised:
        FX._materialised[key] = FX.land_nation_documents(spark, sf, new_scratch_dir(spark, "nation-documents"))
    return read_location_pieces(spark, FX._materialised[key])[table]


def q_giant_cities_outer(spark, sf):
    """GE2, GE4 on one document per nation, which no row ever holds."""
    return comparable(flatten_cities(_giant(spark, sf, "cities"), outer=True, run_ts=RUN_TS))


def q_giant_states_inner(spark, sf):
    return comparable(flatten_states(_giant(spark, sf, "states"), outer=False, run_ts=RUN_TS))


def q_table_replace_roundtrip(spark, sf):
    docs = FX.location_docs(spark, sf)
    loc = new_scratch_dir(spark, "table-cities")
    name = f"cities_{loc.rsplit('-', 1)[-1]}"
    parts = S.PARTITIONING["cities"]
    # First load: inner rows only; the replacement must fully supersede it.
    write_table(flatten_cities(docs, outer=False, run_ts=RUN_TS), name, SCRATCH_DB, path=loc, partition_by=parts)
    write_table(flatten_cities(docs, outer=True, run_ts=RUN_TS), name, SCRATCH_DB, path=loc, partition_by=parts)
    return comparable(read_contract(spark.table(f"{SCRATCH_DB}.{name}"), S.CITIES_COLUMNS))


def _elt_single(spark, sf, dataset: str, table: str) -> DataFrame:
    """The single-dataset ELT path: convert nothing, read the preprocessed
    documents (and population), transform (inner explode for states and
    cities), replace the table, read back."""
    docs_path = FX.location_docs_path(spark, sf)
    pop_path = None
    if dataset == "countries":
        pop_path = new_scratch_dir(spark, "preprocessed-population")
        FX.population_frame(spark, sf).write.mode("overwrite").parquet(pop_path)
    location = new_scratch_dir(spark, "tables")
    db = f"{SCRATCH_DB}_{location.rsplit('-', 1)[-1]}"
    run_elt(spark, dataset, docs_path, pop_path, location=location, database=db, run_ts=RUN_TS)
    return comparable(read_contract(spark.table(f"{db}.{table}"), S.CONTRACTS[table]))


def q_elt_countries(spark, sf):
    # partitioned by country_code; population joined from its Parquet
    return _elt_single(spark, sf, "countries", "countries")


def q_elt_states(spark, sf):
    return _elt_single(spark, sf, "states", "states")


def q_elt_cities(spark, sf):
    return _elt_single(spark, sf, "cities", "cities")


def _elt_combined(spark, sf) -> str:
    """The combined (states_cities, outer explode) ELT run once per
    process; returns the database holding its ``states`` and ``cities``."""
    key = ("elt_combined", sf)
    # The cached name is only good while this session's catalog still has
    # the tables (a new session starts with an empty session catalog).
    cached = FX._materialised.get(key)
    if cached is None or not all(spark.catalog.tableExists(f"{cached}.{t}") for t in ("states", "cities")):
        location = new_scratch_dir(spark, "tables")
        db = f"{SCRATCH_DB}_{location.rsplit('-', 1)[-1]}"
        run_elt(spark, "states_cities", FX.location_docs_path(spark, sf), location=location, database=db, run_ts=RUN_TS)
        FX._materialised[key] = db
    return FX._materialised[key]


def q_sql_states_filter(spark, sf):
    """TR7 as SQL on the catalog table by three-part name (SC3, FI1)."""
    db = _elt_combined(spark, sf)
    return comparable(spot_check_sql(spark, f"spark_catalog.{db}.states", "state_name", "1-URGENT"))


CITY_ORDER = ["city_id", "state_id", "country_id", "city_name", "latitude", "longitude"]


def q_sql_cities_top10(spark, sf):
    """TR7 as SQL: ten cities of the written table, in a total order so
    the ten are the same every run (the original's bare LIMIT is not)."""
    db = _elt_combined(spark, sf)
    return comparable(spot_check_sql(spark, f"spark_catalog.{db}.cities", n=10, order_by=CITY_ORDER))


def q_validate_cities(spark, sf):
    cities = flatten_cities(FX.location_docs(spark, sf), outer=True, run_ts=RUN_TS)
    written, _ = _scratch_table(spark, cities, "cities", S.PARTITIONING["cities"])
    return validation_checks(written, "cities", ["city_id"])


def q_population_duplicates(spark, sf):
    return validation_checks(FX.population_frame(spark, sf, unique=False), "population", ["Alpha_3"])


def q_country_codes(spark, sf):
    # one row per supplier, so codes repeat: duplicates are kept
    return country_codes(FX.population_frame(spark, sf, unique=False))


def q_location_pipeline(spark, sf):
    raw_loc, raw_pop = _raw_json(spark, sf)
    work = new_scratch_dir(spark, "pipeline")
    db = f"{SCRATCH_DB}_{work.rsplit('-', 1)[-1]}"
    return run_location_pipeline(spark, raw_loc, raw_pop, work, database=db, run_ts=RUN_TS)


# --- news queries --------------------------------------------------------------


EXTRA_FIELDS = ("id", "title")


def extra_columns(df: DataFrame) -> DataFrame:
    """The article fields that no schema declares, or that did not fit, as columns of JSON text."""
    return df.select("*", *(F.col("extra")[k].alias(f"extra_{k}") for k in EXTRA_FIELDS)).drop("extra")


def _responses(spark, sf) -> DataFrame:
    return FX.response_log_frame(spark, sf)


def _landed(spark, sf) -> str:
    key = ("landing", sf)
    if key not in FX._materialised:
        FX._materialised[key] = FX.land_responses(_responses(spark, sf), new_scratch_dir(spark, "landing"))
    return FX._materialised[key]


def q_news_articles(spark, sf):
    articles, _ = news_articles(read_response_log(spark, _landed(spark, sf)))
    return extra_columns(articles.drop("date"))


def q_news_rejects(spark, sf):
    """FI2: rejected responses by request and class; a corrupt line has no request."""
    _, rejects = news_articles(read_response_log(spark, _landed(spark, sf)))
    return rejects.groupBy("country", "topic", "page", "response_class").agg(F.count(F.lit(1)).alias("n"))


def q_news_layout_read(spark, sf):
    """SC7 for the plain layout: keys parsed from the file paths."""
    key = ("plain-layout", sf)
    if key not in FX._materialised:
        articles, _ = news_articles(read_response_log(spark, _landed(spark, sf)))
        FX._materialised[key] = FX.land_plain_layout(articles, new_scratch_dir(spark, "plain-layout"))
    return extra_columns(read_news_layout(spark, FX._materialised[key]))


def q_news_files_load(spark, sf):
    """SC6 one body per file (whole-file text) -> TR12 load -> SC7 read:
    the articles appended from a per-request landing, stamped with the
    run's load time (a file carries no request time or page)."""
    table = new_scratch_dir(spark, "news-files-table")
    load_news(spark, _landed_files(spark, sf), table, landing="files", run_ts=RUN_TS)
    return extra_columns(read_news_table(spark, table, NEWS_TABLE))


def _landed_files(spark, sf) -> str:
    key = ("landing-files", sf)
    if key not in FX._materialised:
        FX._materialised[key] = FX.land_response_files(_responses(spark, sf), new_scratch_dir(spark, "landing-files"))
    return FX._materialised[key]


def q_news_files_stream(spark, sf):
    """ST1 over the one-body-per-file landing: a second run on the same
    checkpoint finds no new file and adds no row."""
    landing = _landed_files(spark, sf)
    table = new_scratch_dir(spark, "news-files-stream")
    ckpt = new_scratch_dir(spark, "news-files-stream-ckpt")
    run_news_stream_once(spark, landing, table, ckpt, landing="files", run_ts=RUN_TS)
    run_news_stream_once(spark, landing, table, ckpt, landing="files", run_ts=RUN_TS)
    return extra_columns(read_news_table(spark, table, NEWS_TABLE))


def q_news_class(spark, sf):
    parsed = classify_responses(parse_responses(read_response_log(spark, _landed(spark, sf))))
    return parsed.select("country", "topic", "page", "status", "response_class")


def _seen_and_gaps(spark, sf):
    responses = read_response_log(spark, _landed(spark, sf))
    articles, _ = news_articles(responses)
    # every country of the reference list (TR8), requested before or not
    codes = country_codes(FX.population_frame(spark, sf)).union(responses.select("country").where("country is not null"))
    grid = request_grid(codes.toDF("country"))
    return grid, coverage_gaps(grid, articles)


def q_coverage_missing(spark, sf):
    return _seen_and_gaps(spark, sf)[1]


def q_request_urls(spark, sf):
    return build_requests(_seen_and_gaps(spark, sf)[1])


def q_random_requests(spark, sf):
    grid, _ = _seen_and_gaps(spark, sf)
    return build_requests(sample_requests(grid, n=3, seed=7))


def q_weighted_requests(spark, sf):
    """SA1 by need: pairs that lack articles, the emptier the likelier."""
    grid, _ = _seen_and_gaps(spark, sf)
    articles, _ = news_articles(read_response_log(spark, _landed(spark, sf)))
    return sample_by_need(grid, articles, target=50, n=20, seed=11)


def q_validate_refs(spark, sf):
    """TR7 across the flattened tables: inner cities against outer states, outer states against countries."""
    docs = FX.location_docs(spark, sf)
    countries = transform_countries(docs, FX.population_frame(spark, sf), RUN_TS)
    states = flatten_states(docs, outer=True, run_ts=RUN_TS)
    # of one status only: the cities of the others become orphans
    return location_reference_checks(countries, states.where("state_code = 'F'"), flatten_cities(docs, outer=False, run_ts=RUN_TS))


def q_news_paths(spark, sf):
    from geonest.functions.scalars import news_storage_path

    ev = FX.table(spark, sf, "events")
    return ev.select("event_id", news_storage_path("ts", F.col("event_type"), F.col("user_id").cast("string")).alias("path"))


def q_iso_timestamps(spark, sf):
    from geonest.functions.scalars import iso_utc

    ev = FX.table(spark, sf, "events")
    return ev.select("event_id", iso_utc("ts").alias("call_timestamp"))


NEWS_TABLE = T.StructType(
    [
        T.StructField("page", T.LongType()),
        T.StructField("id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        T.StructField("extra", T.MapType(T.StringType(), T.StringType())),
        T.StructField("call_timestamp", T.StringType()),
        T.StructField("date", T.StringType()),
        T.StructField("country", T.StringType()),
        T.StructField("topic", T.StringType()),
    ]
)


def q_news_append_roundtrip(spark, sf):
    landing = _landed(spark, sf)
    table = new_scratch_dir(spark, "news-table")
    load_news(spark, landing, table)
    load_news(spark, landing, table)  # append semantics: a second load adds rows
    return extra_columns(read_news_table(spark, table, NEWS_TABLE))


def q_news_stream_append(spark, sf):
    landing = _landed(spark, sf)
    table = new_scratch_dir(spark, "news-stream")
    ckpt = new_scratch_dir(spark, "news-stream-ckpt")
    run_news_stream_once(spark, landing, table, ckpt)
    run_news_stream_once(spark, landing, table, ckpt)  # no new files: no new rows
    return extra_columns(read_news_table(spark, table, NEWS_TABLE))


def q_news_stream_rejects(spark, sf):
    """FI2 in ST1: the rejects that the stream wrote with its articles."""
    table, ckpt = new_scratch_dir(spark, "news-rejects"), new_scratch_dir(spark, "news-rejects-ckpt")
    for _ in range(2):  # no new files: no new rows
        run_news_stream_once(spark, _landed(spark, sf), table, ckpt)
    return read_news_rejects(spark, table).groupBy("country", "topic", "page", "response_class").agg(F.count(F.lit(1)).alias("n"))


def q_news_compacted(spark, sf):
    """SK6: two loads compacted into one."""
    table = new_scratch_dir(spark, "news-compacted")
    load_news(spark, _landed(spark, sf), table)
    load_news(spark, _landed(spark, sf), table)
    compact_news(spark, table)
    return extra_columns(read_news_table(spark, table, NEWS_TABLE))


def q_news_new_only(spark, sf):
    """TR12, ST1: a landing loaded by the stream and again by a batch, where
    only articles that the table does not have are asked for."""
    table = new_scratch_dir(spark, "news-new-only")
    run_news_stream_once(spark, _landed(spark, sf), table, new_scratch_dir(spark, "news-new-only-ckpt"), new_only=True)
    load_news(spark, _landed(spark, sf), table, new_only=True)
    return extra_columns(read_news_table(spark, table, NEWS_TABLE))


def q_news_stream_then_load(spark, sf):
    """ST1 and TR12 on one table: streamed rows, then a batch load of the same landing."""
    landing = _landed(spark, sf)
    table = new_scratch_dir(spark, "news-mixed")
    run_news_stream_once(spark, landing, table, new_scratch_dir(spark, "news-mixed-ckpt"))
    load_news(spark, landing, table)
    return extra_columns(read_news_table(spark, table, NEWS_TABLE))


QUERIES = {
    "cities_outer": q_cities_outer,
    "cities_inner": q_cities_inner,
    "states_outer": q_states_outer,
    "states_inner": q_states_inner,
    "stamped_states": q_stamped_states,
    "countries": q_countries,
    "countries_sql": q_countries_sql,
    "filter_eq": q_filter_eq,
    "top10": q_top10,
    "json_to_parquet": q_json_to_parquet,
    "json_ranges_convert": q_json_ranges_convert,
    "giant_cities_outer": q_giant_cities_outer,
    "giant_states_inner": q_giant_states_inner,
    "table_replace_roundtrip": q_table_replace_roundtrip,
    "elt_countries": q_elt_countries,
    "elt_states": q_elt_states,
    "elt_cities": q_elt_cities,
    "sql_states_filter": q_sql_states_filter,
    "sql_cities_top10": q_sql_cities_top10,
    "validate_cities": q_validate_cities,
    "population_duplicates": q_population_duplicates,
    "country_codes": q_country_codes,
    "location_pipeline": q_location_pipeline,
    "news_articles": q_news_articles,
    "news_class": q_news_class,
    "news_rejects": q_news_rejects,
    "news_layout_read": q_news_layout_read,
    "news_files_load": q_news_files_load,
    "coverage_missing": q_coverage_missing,
    "request_urls": q_request_urls,
    "random_requests": q_random_requests,
    "weighted_requests": q_weighted_requests,
    "validate_refs": q_validate_refs,
    "news_paths": q_news_paths,
    "iso_timestamps": q_iso_timestamps,
    "news_append_roundtrip": q_news_append_roundtrip,
    "news_stream_append": q_news_stream_append,
    "news_files_stream": q_news_files_stream,
    "news_stream_then_load": q_news_stream_then_load,
    "news_stream_rejects": q_news_stream_rejects,
    "news_compacted": q_news_compacted,
    "news_new_only": q_news_new_only,
}
