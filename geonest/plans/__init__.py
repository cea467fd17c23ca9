from geonest.plans.location import (  # noqa: F401
    convert_json_to_parquet,
    dataset_frames,
    run_elt,
    run_location_pipeline,
)
from geonest.plans.news import load_news, news_articles  # noqa: F401
from geonest.plans.validate import spot_check, spot_check_sql, validation_checks  # noqa: F401
