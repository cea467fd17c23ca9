"""News load (TR12): landed responses -> partitioned article table."""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from contextlib import contextmanager, nullcontext
from itertools import chain

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from geonest import schemas as S
from geonest.operators.news import articles_from_responses
from geonest.session import FREE_SHUFFLES, session_conf
from geonest.sinks.commit_log import CommitLog
from geonest.sinks.files import cluster_by, write_partitioned
from geonest.functions.scalars import run_stamp, utc_date
from geonest.plans.location import new_run_ts
from geonest.sources.news import landing_groups, load_folder, read_loads, read_news_rejects, read_news_table, read_response_files, read_response_log, rejects_path

NEWS_PARTITIONS = ["date", "country", "topic"]
#: One body per file: Spark packs a file as 4 MiB at least, a dozen files to a
#: task; bodies are some KB, and a task of hundreds costs less than its start.
#: Nor is a listing of them kept in the driver, which reads each file once.
FILES_CONF = {"spark.sql.files.openCostInBytes": str(256 << 10), "spark.sql.hive.filesourcePartitionFileCacheSize": "0"}


def packed_files(spark: SparkSession, landing: str):
    """The session's settings while a landing of this kind is read. A stream
    plans its reads by the session that it was started in, so this must hold
    there while it runs; set in a micro-batch it comes too late."""
    return session_conf(spark, FILES_CONF if landing == "files" else {})


def news_articles(responses: DataFrame, article: T.StructType = S.ARTICLE) -> tuple[DataFrame, DataFrame]:
    """Articles of ok responses, stamped with the request time, with a
    ``yyyy-MM-dd`` ``date`` key (a ``yyyy/MM/dd`` value would be escaped in
    a partition folder name); and the rejected responses."""
    articles, rejects = articles_from_responses(
        responses, F.col("requested_at"), keep=("country", "topic", "page", "requested_at"), article=article
    )
    articles = articles.withColumn("date", utc_date("requested_at")).drop("requested_at")
    return articles, rejects


def file_envelopes(files: DataFrame, run_ts=None) -> DataFrame:
    """Envelope of one-body-per-file responses: a file carries no request
    time or page, so ``requested_at`` is the load time (``run_ts``, else
    the query's -- in a stream, the micro-batch's -- current time)."""
    return files.select(
        "country", "topic", F.lit(None).cast("long").alias("page"),
        run_stamp(run_ts).alias("requested_at"), "body",
    )


@contextmanager
def read_once(files: DataFrame, rest: Iterable[DataFrame], log: CommitLog, load: str):
    """One-body-per-file responses as Parquet beside the table while a load is
    written: opening a file costs more than its text, and articles and rejects
    are two jobs. They are clustered by the folder keys here, where they are
    smaller than their articles, and not again. ``rest``: as in ``write_load``."""
    spark, path = files.sparkSession, log.staging(load)
    try:
        with session_conf(spark, FREE_SHUFFLES):
            for i, part in enumerate(chain([files], rest)):
                writer = cluster_by(part, ["country", "topic"]).write.mode("append" if i else "overwrite")
                writer.option("compression", "zstd").parquet(path)
        yield spark.read.schema(files.schema).parquet(path)
    finally:
        log.discard(load)


def write_load(
    responses: DataFrame, table_path: str, load: str, article: T.StructType = S.ARTICLE, new_only: bool = False, files: bool = False,
    rest: Iterable[DataFrame] = (),
) -> bool:
    """Write the articles and the rejects of ``responses`` as one load and
    commit it. A load that is committed already is left as it is (False), so
    a micro-batch that runs again changes nothing. Files that an attempt
    which failed has left under the load's name are replaced.

    ``new_only`` leaves out articles (by ``article_key``) that the table
    already has, and repeats within the load. ``files``: the responses are one
    body per file, of one load time; ``rest`` has those that are staged after
    them, one frame at a time."""
    spark = responses.sparkSession
    log = CommitLog(spark, table_path).open()
    if log.has(load):
        return False
    with read_once(responses, rest, log, load) if files else nullcontext(responses) as held:
        articles, rejects = news_articles(held, article)
        if new_only:
            articles = only_new(articles, table_path)
        with session_conf(spark, FREE_SHUFFLES):
            write_partitioned(articles, load_folder(table_path, load), NEWS_PARTITIONS, clustered=files and not new_only)
        # few rows: one shuffle-free write, no folders by key
        rejects.write.mode("overwrite").parquet(load_folder(rejects_path(table_path), load))
    return log.commit(load)


#: Columns that tell when and how an article was fetched, not what it is.
FETCH_COLUMNS = ("page", "call_timestamp", "date")


def article_key(articles: DataFrame) -> Column:
    """What makes two rows the same article: all but the time and page of its
    request (a digest of the rest, nulls and empty texts told apart)."""
    kinds = dict(articles.dtypes)
    rest = [
        F.sort_array(F.map_entries(c)).alias(c) if kinds[c].startswith("map") else F.col(c)
        for c in sorted(articles.columns) if c not in FETCH_COLUMNS
    ]
    return F.unhex(F.sha2(F.to_json(F.struct(*rest)), 256))


def only_new(articles: DataFrame, table_path: str) -> DataFrame:
    """Rows of ``articles`` whose key the table does not have, one per key (the
    smallest request time and page). Keys are compared, not rows: an
    aggregate and an anti join on a digest, whose values are spread evenly."""
    spark = articles.sparkSession
    keyed = articles.withColumn("_key", article_key(articles))
    order = [F.col(c) for c in ("call_timestamp", "page", "date")]
    firsts = keyed.groupBy("_key").agg(F.min_by(F.struct(*articles.columns), F.struct(*order)).alias("row"))
    if read_loads(spark, table_path):
        schema = T.StructType(articles.schema.fields)
        known = read_news_table(spark, table_path, schema)
        firsts = firsts.join(known.select(article_key(known).alias("_key")).distinct(), "_key", "left_anti")
    return firsts.select("row.*")


def load_news(
    spark: SparkSession, landing_path: str, table_path: str, landing: str = "log", run_ts=None, article: T.StructType = S.ARTICLE,
    new_only: bool = False,
) -> DataFrame:
    """TR12: append the articles of every landed response under
    ``load=<id>/date=/country=/topic=``, a new load each time, and the
    rejected responses beside the table; returns the rejects as written.
    ``article`` types the article fields; others are kept in ``extra``.

    The load counts for readers once all of it is written (``CommitLog``).
    ``landing="log"``: JSON lines with request keys and time;
    ``landing="files"``: one body per ``<country>/<topic>/<file>``, stamped
    with ``run_ts`` (one load time per run). ``new_only``: as in ``write_load``."""
    load = f"batch-{uuid.uuid4().hex}"
    if landing == "log":
        write_load(read_response_log(spark, landing_path), table_path, load, article, new_only)
    elif landing == "files":
        stamp = run_ts or new_run_ts()
        parts = (file_envelopes(read_response_files(spark, paths), stamp) for paths in landing_groups(spark, landing_path))
        with packed_files(spark, landing):
            write_load(next(parts), table_path, load, article, new_only, files=True, rest=parts)
    else:
        raise ValueError(f"landing must be 'log' or 'files', not {landing!r}")
    return read_news_rejects(spark, table_path, [load])


def compact_news(spark: SparkSession, table_path: str, target_bytes: int = 128 << 20) -> str | None:
    """SK6: the files of all loads that count, written anew as one load of
    files of about ``target_bytes`` and put in their place by one commit;
    rows stay as they are. Returns the load's name, None if there is nothing
    to gain. One compaction at a time; loads may go on meanwhile.

    The rebalance packs the folders' rows into tasks by their measured size:
    small folders share a task, a folder over the target is cut."""
    loads = read_loads(spark, table_path)
    if not loads:
        return None
    load = f"compact-{uuid.uuid4().hex}"
    with session_conf(spark, {"spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_bytes), "spark.sql.sources.partitionColumnTypeInference.enabled": "false"}):
        rows = spark.read.option("basePath", table_path).option("mergeSchema", True).parquet(*(load_folder(table_path, x) for x in loads)).drop("load")
        write_partitioned(rows, load_folder(table_path, load), NEWS_PARTITIONS)
        old = [load_folder(rejects_path(table_path), x) for x in loads]
        rejects = spark.read.option("mergeSchema", True).parquet(*old)
        rejects.hint("rebalance").write.mode("overwrite").parquet(load_folder(rejects_path(table_path), load))
    CommitLog(spark, table_path).commit(load, replaces=loads)
    return load
