from geonest.functions.scalars import (  # noqa: F401
    date_path,
    iso_utc,
    news_storage_path,
    quoted,
    request_query_string,
    run_stamp,
    source_timestamp,
    utc_date,
    to_float,
)
