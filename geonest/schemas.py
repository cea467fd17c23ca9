"""Input schemas and output contracts.

Known inputs are always read with an explicit schema: inferring from JSON
costs a pass over the data and turns all-empty arrays into array<string>.
"""

from pyspark.sql import types as T

CITY = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("name", T.StringType()),
        T.StructField("latitude", T.StringType()),
        T.StructField("longitude", T.StringType()),
    ]
)

STATE = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("name", T.StringType()),
        T.StructField("state_code", T.StringType()),
        T.StructField("latitude", T.StringType()),
        T.StructField("longitude", T.StringType()),
        T.StructField("cities", T.ArrayType(CITY)),
    ]
)

COUNTRY_SCALARS = [
    ("id", T.LongType()),
    ("name", T.StringType()),
    ("iso3", T.StringType()),
    ("capital", T.StringType()),
    ("currency", T.StringType()),
    ("currency_name", T.StringType()),
    ("currency_symbol", T.StringType()),
    ("region", T.StringType()),
    ("subregion", T.StringType()),
    ("phone_code", T.StringType()),
    ("emoji", T.StringType()),
    ("latitude", T.StringType()),
    ("longitude", T.StringType()),
]

COUNTRY = T.StructType(
    [T.StructField(n, t) for n, t in COUNTRY_SCALARS]
    + [T.StructField("states", T.ArrayType(STATE))]
)

POPULATION = T.StructType(
    [
        T.StructField("Alpha_2", T.StringType()),
        T.StructField("Alpha_3", T.StringType()),
        T.StructField("Population", T.LongType()),
    ]
)

# Article fields are the caller's choice; the envelope is fixed.
ARTICLE = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)


def response_schema(article: T.StructType = ARTICLE) -> T.StructType:
    return T.StructType(
        [
            T.StructField("status", T.StringType()),
            T.StructField("articles", T.ArrayType(article)),
        ]
    )


# A landed API response: one JSON line per request.
RESPONSE_ENVELOPE = T.StructType(
    [
        T.StructField("country", T.StringType()),
        T.StructField("topic", T.StringType()),
        T.StructField("page", T.LongType()),
        T.StructField("requested_at", T.TimestampType()),
        T.StructField("body", T.StringType()),
    ]
)

# Output contracts, in column order.
COUNTRIES_COLUMNS = [
    "country_id",
    "country_name",
    "country_code",
    "capital",
    "currency",
    "currency_name",
    "currency_symbol",
    "region",
    "subregion",
    "phone_code",
    "emoji",
    "latitude",
    "longitude",
    "population",
    "population_source_last_updated_at",
    "created_at",
    "last_updated_at",
]

STATES_COLUMNS = [
    "country_id",
    "country_code",
    "state_id",
    "state_name",
    "state_code",
    "latitude",
    "longitude",
    "created_at",
    "last_updated_at",
]

CITIES_COLUMNS = [
    "country_id",
    "country_code",
    "state_id",
    "state_name",
    "state_code",
    "city_id",
    "city_name",
    "latitude",
    "longitude",
    "created_at",
    "last_updated_at",
]

CONTRACTS = {
    "countries": COUNTRIES_COLUMNS,
    "states": STATES_COLUMNS,
    "cities": CITIES_COLUMNS,
}

# Default identity partitioning per table. The original single-dataset job
# also partitions cities by name, about one folder per city: pass
# ``partition_by={"cities": [..., "city_name"]}`` for that.
PARTITIONING = {
    "countries": ["country_code"],
    "states": ["country_code", "state_code"],
    "cities": ["country_code", "state_code"],
}


def assert_contract(df, table: str) -> None:
    """Raise if ``df`` does not have the contract columns in order."""
    want = CONTRACTS[table]
    if df.columns != want:
        raise ValueError(f"{table}: columns {df.columns} do not match contract {want}")
