"""Fixed values that must equal the reference's for identical results."""

# --- fixed values -----------------------------------------------------------
# News topics requested from the news API, in the reference's order.
NEWS_TOPICS = [
    "news",
    "sport",
    "tech",
    "world",
    "finance",
    "politics",
    "business",
    "economics",
    "entertainment",
    "beauty",
    "travel",
    "music",
    "food",
    "science",
    "gaming",
    "energy",
]

# Timestamp stamped on every country row as the population source's last
# update time.
POPULATION_SOURCE_TIMESTAMP = "2020-08-23 16:26:00"

# News request defaults.
NEWS_DEFAULT_QUERY = "Random"
NEWS_DEFAULT_LANG = "en"
NEWS_SORT_BY = "rank"
NEWS_PAGE_SIZE = 100
NEWS_FIRST_PAGE = 1
NEWS_API_NAME = "newscatcher"
NEWS_FILE_NAME = "news_data.parquet"
# Response status text of an empty search.
NEWS_NO_MATCHES_STATUS = "No matches for your search."

# Dataset names accepted by the ELT dispatcher.
DATASETS = ("countries", "states", "cities", "states_cities")

# Catalog defaults of the location tables.
DEFAULT_DATABASE = "location_db"
# --- end fixed values -------------------------------------------------------

# The 216 country codes are not listed here: like the reference's code list
# they are the Alpha_2 column of the population data (see
# geonest.sources.reference.country_codes).
