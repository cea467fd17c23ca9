from geonest.operators.enrich import transform_countries, transform_countries_sql  # noqa: F401
from geonest.operators.flatten import (  # noqa: F401
    explode_cities,
    explode_states,
    flatten_cities,
    flatten_states,
    flatten_states_and_cities,
)
from geonest.operators.news import (  # noqa: F401
    articles_from_responses,
    classify_responses,
    explode_articles,
    parse_responses,
)
from geonest.operators.preview import filter_equals, top_n  # noqa: F401
from geonest.operators.requests import (  # noqa: F401
    build_requests,
    coverage_gaps,
    request_grid,
    sample_requests,
)
