from geonest.sources.catalog import qualified_name, read_table, register_view, sql_on  # noqa: F401
from geonest.sources.json import read_json_lines, read_multiline_json  # noqa: F401
from geonest.sources.news import (  # noqa: F401
    stream_response_files,
    read_news_layout,
    read_news_table,
    read_response_files,
    read_response_log,
)
from geonest.sources.parquet import read_parquet  # noqa: F401
from geonest.sources.reference import country_codes, topics_frame  # noqa: F401
