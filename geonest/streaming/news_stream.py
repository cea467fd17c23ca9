"""Incremental news append with Structured Streaming (ST1).

Landed response files are picked up once each (the checkpoint records
which files were processed), parsed, exploded and written as Parquet under
``load=stream-<query>-<batch>/date=/country=/topic=``; the rejected
responses of the same files go beside the table. Stateless: no watermark or
state store. A micro-batch is one load: both outputs count by one entry of
the table's commit log, and a micro-batch that runs again after that changes
nothing. So every file is loaded once, readers see whole loads only, and
batch loads (``plans.news.load_news``) can write to the same table.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from geonest import schemas as S
from geonest.plans.news import file_envelopes, packed_files, write_load
from geonest.session import session_conf
from geonest.sources.news import GROUP_FILES, stream_response_files, stream_response_log


def start_news_stream(
    spark: SparkSession,
    landing_dir: str,
    table_path: str,
    checkpoint_path: str,
    available_now: bool = True,
    processing_time: str | None = None,
    max_files_per_trigger: int | None = None,
    landing: str = "log",
    run_ts=None,
    article: T.StructType = S.ARTICLE,
    new_only: bool = False,
) -> StreamingQuery:
    """Start the incremental load.

    ``landing="log"``: JSON-lines envelopes; ``landing="files"``: one body
    per ``<country>/<topic>/`` file, stamped with ``run_ts`` or, without
    it, the time of the micro-batch that loads the file. Small files are
    packed to tasks as ``plans.news.packed_files`` says while it holds in
    ``spark``.

    A micro-batch is written like a batch load: clustered by the folder
    keys through a rebalance, so each task writes few folders, and a folder
    with a large share of the rows is split over several tasks."""
    if landing == "log":
        responses = stream_response_log(spark, landing_dir, max_files_per_trigger)
    elif landing == "files":
        responses = file_envelopes(stream_response_files(spark, landing_dir, max_files_per_trigger), run_ts)
    else:
        raise ValueError(f"landing must be 'log' or 'files', not {landing!r}")

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        # the query's id is kept in its checkpoint, so it outlives restarts
        query = json.loads(spark.read.text(f"{checkpoint_path}/metadata").first()[0])["id"]
        # a stream's session has adaptive execution off; these writes are batch
        # jobs of their own and need it to split a hot folder
        with packed_files(spark, landing), session_conf(spark, {"spark.sql.adaptive.enabled": "true"}):
            write_load(batch, table_path, f"stream-{query}-{batch_id}", article, new_only, files=landing == "files")

    w = responses.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint_path).outputMode("append")
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time or "1 minute")
    return w.start()


def run_news_stream_once(
    spark: SparkSession, landing_dir: str, table_path: str, checkpoint_path: str, landing: str = "log", run_ts=None,
    article: T.StructType = S.ARTICLE, new_only: bool = False,
) -> None:
    """Process every file landed so far, then stop; of a per-file landing
    ``GROUP_FILES`` in a micro-batch."""
    with packed_files(spark, landing):
        q = start_news_stream(
            spark, landing_dir, table_path, checkpoint_path, available_now=True, max_files_per_trigger=GROUP_FILES if landing == "files" else None,
            landing=landing, run_ts=run_ts, article=article, new_only=new_only,
        )
        q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
