"""News request planning (JN2, JN3, SA1, FN7-FN8, TR9)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geonest import constants as K
from geonest.functions.scalars import quoted, request_query_string


def request_grid(countries: DataFrame, topics=K.NEWS_TOPICS, country_col: str = "country") -> DataFrame:
    """JN2: every (country, topic) pair.

    ``topics`` is a bounded literal list (the fixed topic list by default),
    so the pairing is a generator over that list on each country row, a
    narrow operator, instead of a cross join between two data sets.
    """
    topic_arr = F.array(*[F.lit(t) for t in dict.fromkeys(topics)])
    distinct = countries.select(F.col(country_col).alias("country")).distinct()
    return distinct.select("country", F.explode(topic_arr).alias("topic"))


def coverage_gaps(grid: DataFrame, seen: DataFrame) -> DataFrame:
    """JN3: pairs of the grid that have no article yet (left anti join).

    ``seen`` is reduced to distinct (country, topic) before the join, a
    partial aggregate that shrinks it to at most one row per pair."""
    seen_pairs = seen.select("country", "topic").dropDuplicates()
    return grid.join(seen_pairs, ["country", "topic"], "left_anti")


def sample_requests(grid: DataFrame, n: int = 1, seed: int = 0) -> DataFrame:
    """SA1: a seeded sample of ``n`` pairs: those with the smallest md5 of seed
    and pair, so it is the same however the grid is partitioned. Top-n keeps
    at most ``n`` rows per task."""
    pick = F.md5(F.concat(F.lit(str(seed)), F.lit("|"), F.coalesce("country", F.lit("")), F.lit("|"), F.coalesce("topic", F.lit(""))))
    return grid.orderBy(pick, "country", "topic").limit(n)


def sample_by_need(grid: DataFrame, seen: DataFrame, target: int, n: int = 1, seed: int = 0) -> DataFrame:
    """SA1 weighed by JN3: ``n`` pairs without replacement, the chance of each in
    proportion to what it lacks of ``target`` articles; pairs that lack none
    are never chosen. Adds ``lacking``.

    Each pair draws a number from the md5 of seed and pair, so the choice is
    the same under any partitioning, and those with the smallest
    -ln(draw) / weight are taken (exponential keys). Articles are counted by
    pair before the join; top-n keeps at most ``n`` rows per task."""
    counts = seen.groupBy("country", "topic").agg(F.count(F.lit(1)).alias("_n"))
    pairs = grid.join(counts, ["country", "topic"], "left").withColumn("lacking", F.lit(target) - F.coalesce("_n", F.lit(0))).where("lacking > 0")
    digest = F.md5(F.concat(F.lit(f"{seed}|"), F.coalesce("country", F.lit("")), F.lit("|"), F.coalesce("topic", F.lit(""))))
    draw = (F.conv(F.substring(digest, 1, 12), 16, 10).cast("double") + 1) / F.lit(float(1 << 48))
    return pairs.orderBy(-F.ln(draw) / F.col("lacking"), "country", "topic").limit(n).select("country", "topic", "lacking")


def build_requests(
    pairs: DataFrame,
    query: str = K.NEWS_DEFAULT_QUERY,
    lang: str = K.NEWS_DEFAULT_LANG,
    base_url: str = "",
) -> DataFrame:
    """TR9: request parameters and full URL for each (country, topic)."""
    q = quoted(F.lit(query))
    qs = request_query_string(q, F.lit(lang), F.col("country"), F.col("topic"))
    return pairs.select(
        "country",
        "topic",
        q.alias("q"),
        F.lit(lang).alias("lang"),
        F.lit(K.NEWS_SORT_BY).alias("sort_by"),
        F.lit(K.NEWS_PAGE_SIZE).alias("page_size"),
        F.lit(K.NEWS_FIRST_PAGE).alias("page"),
        F.concat(F.lit(base_url + "search?"), qs).alias("full_url"),
    )
