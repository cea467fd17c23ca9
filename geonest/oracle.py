"""DuckDB oracle SQL over the flat driver tables, one per registered query.

The nested fixture is built from the same tables, so these flat joins are
an independent statement of what flattening must return.
"""

from __future__ import annotations

from geonest import constants as K
from geonest.fixtures import CITIES_PER_PART, FIXED_RUN_TS, STATES_PER_PART

TS = f"TIMESTAMP '{FIXED_RUN_TS}'"


def _money(expr: str) -> str:
    return f"CAST(CAST({expr} AS DECIMAL(14,2)) AS VARCHAR)"


def _float(expr: str) -> str:
    return f"CAST(TRY_CAST({expr} AS FLOAT) AS DOUBLE)"


# One document per customer and range of order keys; one for a customer
# without orders, or of segment HOUSEHOLD (part is null).
COUNTRY_DOCS = f"""
SELECT p.part, c.c_custkey AS id, c.c_name AS name, 'N' || c.c_nationkey AS iso3,
       c.c_mktsegment AS capital, 'CUR' || c.c_nationkey AS currency,
       n.n_name || ' currency' AS currency_name, '$' AS currency_symbol,
       r.r_name AS region, n.n_name AS subregion,
       CAST(c.c_nationkey + 1 AS VARCHAR) AS phone_code, 'flag:N' || c.c_nationkey AS emoji,
       CASE WHEN c.c_mktsegment = 'AUTOMOBILE' THEN 'n/a' ELSE {_money('c.c_acctbal')} END AS latitude,
       {_money('-c.c_acctbal')} AS longitude,
       c.c_mktsegment AS segment
FROM customer c
LEFT JOIN (SELECT DISTINCT o_custkey, o_orderkey // {STATES_PER_PART} AS part FROM orders) p
  ON p.o_custkey = c.c_custkey AND c.c_mktsegment IS DISTINCT FROM 'HOUSEHOLD'
LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey
LEFT JOIN region r ON r.r_regionkey = n.n_regionkey
"""

_STATE_JOIN = f"orders o ON o.o_custkey = d.id AND o.o_orderkey // {STATES_PER_PART} = d.part"
# One state entry per order and range of line numbers; one for an order without lines.
_ENTRIES = f"SELECT DISTINCT l_orderkey, l_linenumber // {CITIES_PER_PART} AS part FROM lineitem"


def states_sql(outer: bool) -> str:
    j = "LEFT JOIN" if outer else "JOIN"
    lon = f"CASE WHEN o.o_orderstatus = 'P' THEN '' ELSE {_money('-o.o_totalprice')} END"
    return f"""
SELECT d.id AS country_id, d.iso3 AS country_code, o.o_orderkey AS state_id,
       o.o_orderpriority AS state_name, o.o_orderstatus AS state_code,
       {_float(_money('o.o_totalprice'))} AS latitude, {_float(lon)} AS longitude,
       {TS} AS created_at, {TS} AS last_updated_at
FROM ({COUNTRY_DOCS}) d {j} {_STATE_JOIN} LEFT JOIN ({_ENTRIES}) e ON e.l_orderkey = o.o_orderkey
"""


def cities_sql(outer: bool) -> str:
    j = "LEFT JOIN" if outer else "JOIN"
    lat = (
        "CASE WHEN l.l_returnflag = 'R' THEN '' WHEN l.l_returnflag = 'A' THEN NULL "
        f"WHEN l.l_linestatus = 'O' THEN 'n/a' ELSE {_money('l.l_extendedprice')} END"
    )
    return f"""
SELECT d.id AS country_id, d.iso3 AS country_code, o.o_orderkey AS state_id,
       o.o_orderpriority AS state_name, o.o_orderstatus AS state_code,
       l.l_orderkey * 8 + l.l_linenumber AS city_id,
       'Port ' || l.l_returnflag || l.l_linestatus AS city_name,
       {_float(lat)} AS latitude, {_float(_money('-l.l_extendedprice'))} AS longitude,
       {TS} AS created_at, {TS} AS last_updated_at
FROM ({COUNTRY_DOCS}) d {j} {_STATE_JOIN} {j} lineitem l ON l.l_orderkey = o.o_orderkey
"""


POPULATION_UNIQUE = (
    "SELECT 'A' || s_nationkey AS Alpha_2, 'N' || s_nationkey AS Alpha_3, COUNT(*) AS Population "
    "FROM supplier GROUP BY s_nationkey"
)
POPULATION_DUP = (
    "SELECT 'A' || s_nationkey AS Alpha_2, 'N' || s_nationkey AS Alpha_3, s_suppkey AS Population FROM supplier"
)

COUNTRIES = f"""
SELECT d.id AS country_id, d.name AS country_name, d.iso3 AS country_code, d.capital,
       d.currency, d.currency_name, d.currency_symbol, d.region, d.subregion,
       d.phone_code, d.emoji, {_float('d.latitude')} AS latitude, {_float('d.longitude')} AS longitude,
       p.Population AS population,
       TIMESTAMP '{K.POPULATION_SOURCE_TIMESTAMP}' AS population_source_last_updated_at,
       {TS} AS created_at, {TS} AS last_updated_at
FROM ({COUNTRY_DOCS}) d LEFT JOIN ({POPULATION_UNIQUE}) p ON d.iso3 = p.Alpha_3
"""


def checks_sql(table: str, source: str, key: str) -> str:
    return f"""
SELECT '{table}' AS table_name, 'row_count' AS check_name, COUNT(*) AS value FROM ({source}) s
UNION ALL
SELECT '{table}', 'null_{key}', COUNT(*) FILTER (WHERE {key} IS NULL) FROM ({source}) s
UNION ALL
SELECT '{table}', 'duplicate_keys', COUNT(*) FROM
  (SELECT {key} FROM ({source}) s WHERE {key} IS NOT NULL GROUP BY {key} HAVING COUNT(*) > 1) g
"""


_TOPICS = "[" + ", ".join(f"'{t}'" for t in K.NEWS_TOPICS) + "]"
TOPIC = f"({_TOPICS})[(TRY_CAST(regexp_extract(source, '(\\d+)$', 1) AS INTEGER) % {len(K.NEWS_TOPICS)}) + 1]"
CALL_TS = "'2024-01-01T00:00:00.000000Z'"
PAGE = f"CAST(doc_id // {K.NEWS_PAGE_SIZE} AS BIGINT)"
# The responses of these sources hold no articles (see the fixture); the
# landed lines of src9 are cut, its files are not.
OK_FILE = "source IS NULL OR source NOT IN ('src3', 'src4', 'src5', 'src7', 'src8')"
OK_SOURCE = "source IS NULL OR source NOT IN ('src3', 'src4', 'src5', 'src7', 'src8', 'src9')"
REQUESTED = f"TIMESTAMP '{FIXED_RUN_TS}' + to_days(CAST({PAGE} % 3 AS INTEGER))"
ARTICLE = """CASE WHEN source IS DISTINCT FROM 'src6' THEN doc_id END AS id, text, n_chars,
       CASE WHEN source = 'src6' THEN '"d' || doc_id || '"' END AS extra_id, '"T' || doc_id || '"' AS extra_title"""

NEWS_ARTICLES = f"""
SELECT upper(lang) AS country, {TOPIC} AS topic, {PAGE} AS page, {ARTICLE},
       strftime({REQUESTED}, '%Y-%m-%dT%H:%M:%S.%fZ') AS call_timestamp
FROM documents WHERE {OK_SOURCE}
"""

_CLASS = """CASE WHEN source = 'src9' THEN 'corrupt_line' WHEN source = 'src5' THEN 'empty'
            WHEN source IN ('src3', 'src8') THEN 'malformed'
            WHEN source IN ('src4', 'src7') THEN 'no_articles' ELSE 'ok' END"""

NEWS_CLASS = f"""
SELECT CASE WHEN source IS DISTINCT FROM 'src9' THEN upper(lang) END AS country,
       CASE WHEN source IS DISTINCT FROM 'src9' THEN {TOPIC} END AS topic,
       CASE WHEN source IS DISTINCT FROM 'src9' THEN {PAGE} END AS page,
       CASE WHEN source = 'src4' THEN '{K.NEWS_NO_MATCHES_STATUS}'
            WHEN source IN ('src3', 'src5', 'src7', 'src8', 'src9') THEN NULL ELSE 'ok' END AS status,
       {_CLASS} AS response_class
FROM documents GROUP BY lang, source, {PAGE}
"""

NEWS_REJECTS = f"""
SELECT country, topic, page, response_class, count(*) AS n FROM ({NEWS_CLASS}) c
WHERE response_class <> 'ok' GROUP BY ALL
"""

NEWS_TABLE_ROWS = f"""
SELECT a.*, substring(call_timestamp, 1, 10) AS date FROM ({NEWS_ARTICLES}) a
"""

# Countries of the reference list, and those of landed lines that can be read.
GRID = f"""
SELECT DISTINCT country, topic FROM (
  SELECT 'A' || s_nationkey AS country FROM supplier
  UNION SELECT upper(lang) FROM documents WHERE lang IS NOT NULL AND source IS DISTINCT FROM 'src9'
) c, (SELECT unnest({_TOPICS}) AS topic) t
"""

COVERAGE_MISSING = f"""
SELECT g.country, g.topic FROM ({GRID}) g
WHERE NOT EXISTS (
  SELECT 1 FROM documents WHERE ({OK_SOURCE}) AND upper(lang) = g.country AND {TOPIC} = g.topic)
"""


def request_urls_sql(pairs: str) -> str:
    return f"""
SELECT country, topic, '"{K.NEWS_DEFAULT_QUERY}"' AS q, '{K.NEWS_DEFAULT_LANG}' AS lang,
       '{K.NEWS_SORT_BY}' AS sort_by, {K.NEWS_PAGE_SIZE} AS page_size, {K.NEWS_FIRST_PAGE} AS page,
       'search?q=%22{K.NEWS_DEFAULT_QUERY}%22&lang={K.NEWS_DEFAULT_LANG}&countries=' || country
       || '&topic=' || topic || '&sort_by={K.NEWS_SORT_BY}&page_size={K.NEWS_PAGE_SIZE}&page={K.NEWS_FIRST_PAGE}'
       AS full_url
FROM ({pairs}) g
"""


REQUEST_URLS = request_urls_sql(COVERAGE_MISSING)
RANDOM_REQUESTS = request_urls_sql(f"SELECT * FROM ({GRID}) g ORDER BY md5('7|' || country || '|' || topic), country, topic LIMIT 3")

WEIGHTED_REQUESTS = f"""
WITH counts AS (
  SELECT upper(lang) AS country, {TOPIC} AS topic, count(*) AS n FROM documents WHERE {OK_SOURCE} GROUP BY ALL
), need AS (
  SELECT g.country, g.topic, 50 - coalesce(c.n, 0) AS lacking FROM ({GRID}) g LEFT JOIN counts c ON c.country = g.country AND c.topic = g.topic
)
SELECT country, topic, lacking FROM need WHERE lacking > 0
ORDER BY -ln((('0x' || substring(md5('11|' || country || '|' || topic), 1, 12))::BIGINT::DOUBLE + 1) / 281474976710656) / lacking, country, topic LIMIT 20
"""


def _refs(name: str, child: str, parent: str, keys: str) -> str:
    match = " AND ".join(f"c.{k} = p.{k}" for k in keys.split(", "))
    known = " AND ".join(f"{{0}}.{k} IS NOT NULL" for k in keys.split(", "))
    return f"""
SELECT '{name}' AS table_name, 'orphans' AS check_name, count(*) AS value FROM ({child}) c
WHERE {known.format('c')} AND NOT EXISTS (SELECT 1 FROM ({parent}) p WHERE {match})
UNION ALL
SELECT '{name}', 'unreferenced', count(*) FROM ({parent}) p WHERE {known.format('p')} AND NOT EXISTS (SELECT 1 FROM ({child}) c WHERE {match})
"""


_STATES_F = f"SELECT * FROM ({states_sql(True)}) s WHERE state_code = 'F'"
VALIDATE_REFS = _refs("cities", cities_sql(False), _STATES_F, "country_id, state_id") + " UNION ALL " + _refs("states", _STATES_F, COUNTRIES, "country_id")

NEWS_PATHS = f"""
SELECT event_id, concat_ws('/', '{K.NEWS_API_NAME}', strftime(ts, '%Y/%m/%d'), event_type,
                           CAST(user_id AS VARCHAR), '{K.NEWS_FILE_NAME}') AS path
FROM events
"""

ISO_TIMESTAMPS = "SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS call_timestamp FROM events"

NEWS_FILES_ROWS = f"""
SELECT upper(lang) AS country, {TOPIC} AS topic, CAST(NULL AS BIGINT) AS page, {ARTICLE},
       {CALL_TS} AS call_timestamp, '{FIXED_RUN_TS[:10]}' AS date
FROM documents WHERE {OK_FILE}
"""

# One document per nation: its customers are states, their orders cities.
_GIANT_PLACE = "c.c_custkey AS state_id, c.c_name AS state_name, c.c_mktsegment AS state_code"
GIANT_STATES = f"""
SELECT n_nationkey AS country_id, 'N' || n_nationkey AS country_code, {_GIANT_PLACE},
       {_float(_money('c.c_acctbal'))} AS latitude, CAST(NULL AS DOUBLE) AS longitude, {TS} AS created_at, {TS} AS last_updated_at
FROM nation JOIN customer c ON c.c_nationkey = n_nationkey
"""
GIANT_CITIES = f"""
SELECT n_nationkey AS country_id, 'N' || n_nationkey AS country_code, {_GIANT_PLACE},
       o.o_orderkey AS city_id, o.o_orderstatus || ' {{}}[]"' AS city_name,
       {_float(_money('o.o_totalprice'))} AS latitude, CAST(NULL AS DOUBLE) AS longitude, {TS} AS created_at, {TS} AS last_updated_at
FROM nation LEFT JOIN customer c ON c.c_nationkey = n_nationkey LEFT JOIN orders o ON o.o_custkey = c.c_custkey
"""

LOCATION_PIPELINE = " UNION ALL ".join(
    [
        checks_sql("countries", COUNTRIES, "country_id"),
        checks_sql("states", states_sql(True), "state_id"),
        checks_sql("cities", cities_sql(True), "city_id"),
    ]
)

ORACLE_SQL = {
    "cities_outer": cities_sql(True),
    "cities_inner": cities_sql(False),
    "states_outer": states_sql(True),
    "states_inner": states_sql(False),
    "stamped_states": (
        "SELECT country_id, state_id, TIMESTAMP '2025-06-30 23:59:59.123456' AS created_at, "
        f"TIMESTAMP '2025-06-30 23:59:59.123456' AS last_updated_at FROM ({states_sql(True)}) s"
    ),
    "countries": COUNTRIES,
    "countries_sql": COUNTRIES,
    "filter_eq": f"SELECT * FROM ({states_sql(True)}) s WHERE state_name = '1-URGENT'",
    "top10": f"SELECT * FROM ({COUNTRIES}) c ORDER BY country_id LIMIT 10",
    "json_to_parquet": cities_sql(True),
    "json_ranges_convert": cities_sql(True),
    "giant_cities_outer": GIANT_CITIES,
    "giant_states_inner": GIANT_STATES,
    "table_replace_roundtrip": cities_sql(True),
    "elt_countries": COUNTRIES,
    "elt_states": states_sql(False),
    "elt_cities": cities_sql(False),
    "sql_states_filter": f"SELECT * FROM ({states_sql(True)}) s WHERE state_name = '1-URGENT'",
    "sql_cities_top10": (
        f"SELECT * FROM ({cities_sql(True)}) c ORDER BY "
        + ", ".join(f"{k} ASC NULLS LAST" for k in ["city_id", "state_id", "country_id", "city_name", "latitude", "longitude"])
        + " LIMIT 10"
    ),
    "validate_cities": checks_sql("cities", cities_sql(True), "city_id"),
    "population_duplicates": checks_sql("population", POPULATION_DUP, "Alpha_3"),
    "country_codes": "SELECT 'A' || s_nationkey AS Alpha_2 FROM supplier",
    "location_pipeline": LOCATION_PIPELINE,
    "news_articles": NEWS_ARTICLES,
    "news_class": NEWS_CLASS,
    "news_rejects": NEWS_REJECTS,
    "news_layout_read": NEWS_TABLE_ROWS,
    "news_stream_then_load": f"{NEWS_TABLE_ROWS} UNION ALL {NEWS_TABLE_ROWS}",
    "random_requests": RANDOM_REQUESTS,
    "coverage_missing": COVERAGE_MISSING,
    "request_urls": REQUEST_URLS,
    "weighted_requests": WEIGHTED_REQUESTS,
    "validate_refs": VALIDATE_REFS,
    "news_paths": NEWS_PATHS,
    "iso_timestamps": ISO_TIMESTAMPS,
    "news_append_roundtrip": f"{NEWS_TABLE_ROWS} UNION ALL {NEWS_TABLE_ROWS}",
    "news_stream_append": NEWS_TABLE_ROWS,
    "news_stream_rejects": NEWS_REJECTS,
    "news_compacted": f"{NEWS_TABLE_ROWS} UNION ALL {NEWS_TABLE_ROWS}",
    "news_new_only": NEWS_TABLE_ROWS,
    "news_files_load": NEWS_FILES_ROWS,
    "news_files_stream": NEWS_FILES_ROWS,
}
