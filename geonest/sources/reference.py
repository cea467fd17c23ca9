"""Reference lists (SC5, TR8, PR5)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from geonest import constants as K


def topics_frame(spark: SparkSession, topics=K.NEWS_TOPICS) -> DataFrame:
    """The fixed topic list as a one-column DataFrame."""
    return spark.createDataFrame([(t,) for t in topics], "topic string")


def country_codes(population: DataFrame, column: str = "Alpha_2") -> DataFrame:
    """TR8: the country-code list is the ``Alpha_2`` column of the
    population records, in order and with duplicates (no distinct)."""
    return population.select(column)
