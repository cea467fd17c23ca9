"""Command-line jobs (spark-submit entry points).

Option names follow the original jobs, so existing invocations keep
working::

    python -m geonest convert --input_path raw/ --output_path pre/ [--kind population] [--lines] [--declared_only]
    python -m geonest elt --dataset states_cities --preprocess_data_path pre/ \
        [--population_data_path pop/] [--location s3a://.../tables] [--database location_db] \\
        [--partition_by cities=country_code,state_code,city_name] [--replace swap]
    python -m geonest pipeline --raw_locations raw/ --raw_population rawpop/ --work_dir work/
    python -m geonest news-load --landing landing/ --table news/ [--landing_kind files]
    python -m geonest news-stream --landing landing/ --table news/ --checkpoint ckpt/ [--once]

Unlike the original conversion job, an error is not swallowed: it is
raised, so the process exits non-zero and a scheduler does not run the
next step on stale data. The session is stopped only when the command
created it.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from geonest import constants as K
from geonest import schemas as S

SCHEMAS = {"locations": S.COUNTRY, "population": S.POPULATION}


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="geonest", description="geonest Spark jobs")
    p.add_argument("--master", help="Spark master (normally set by spark-submit)")
    sub = p.add_subparsers(dest="command", required=True)

    c = sub.add_parser("convert", help="multi-line JSON documents to Parquet (full replace)")
    c.add_argument("--input_path", required=True)
    c.add_argument("--output_path", required=True)
    c.add_argument("--kind", choices=sorted(SCHEMAS), default="locations", help="input schema")
    c.add_argument("--lines", action="store_true", help="one JSON document per line (splittable)")
    c.add_argument("--split_files", action="store_true", help="whole-file JSON read by splits (large files); declared fields only")
    c.add_argument("--declared_only", action="store_true", help="drop fields that the schema does not declare")

    e = sub.add_parser("elt", help="transform one dataset and replace its table(s)")
    e.add_argument("--dataset", required=True, choices=K.DATASETS)
    e.add_argument("--preprocess_data_path", required=True)
    e.add_argument("--population_data_path")
    e.add_argument("--location", help="folder holding one sub-folder per table")
    e.add_argument("--database", default=K.DEFAULT_DATABASE)
    e.add_argument("--catalog")
    e.add_argument("--partition_by", action="append", default=[], metavar="TABLE=COL,COL", help="partition columns of a table")
    e.add_argument("--replace", choices=["full", "partitions", "swap"], default="full")

    pl = sub.add_parser("pipeline", help="convert both inputs, then countries and states/cities")
    pl.add_argument("--raw_locations", required=True)
    pl.add_argument("--raw_population", required=True)
    pl.add_argument("--work_dir", required=True)
    pl.add_argument("--database", default=K.DEFAULT_DATABASE)
    pl.add_argument("--catalog")

    n = sub.add_parser("news-load", help="append the articles of landed responses")
    n.add_argument("--landing", required=True)
    n.add_argument("--table", required=True)
    n.add_argument("--landing_kind", choices=["log", "files"], default="log")
    n.add_argument("--article", help="article fields as DDL, e.g. 'id bigint, title string'")

    st = sub.add_parser("news-stream", help="incremental news append (Structured Streaming)")
    st.add_argument("--landing", required=True)
    st.add_argument("--table", required=True)
    st.add_argument("--checkpoint", required=True)
    st.add_argument("--landing_kind", choices=["log", "files"], default="log")
    st.add_argument("--once", action="store_true", help="process what has landed, then stop")
    st.add_argument("--interval", default="1 minute", help="trigger interval when not --once")
    st.add_argument("--max_files_per_trigger", type=int)
    st.add_argument("--article", help="article fields as DDL")
    return p


def run(args: argparse.Namespace, spark: SparkSession):
    """Run one parsed command; returns its result DataFrame (checks or
    rejects) when it has one."""
    from geonest.plans.location import convert_json_to_parquet, run_elt, run_location_pipeline
    from geonest.plans.news import load_news, packed_files
    from geonest.streaming.news_stream import start_news_stream

    if args.command == "convert":
        convert_json_to_parquet(
            spark, args.input_path, args.output_path, SCHEMAS[args.kind], lines=args.lines, declared_only=args.declared_only, split_files=args.split_files
        )
        return None
    if args.command == "elt":
        return run_elt(
            spark, args.dataset, args.preprocess_data_path, args.population_data_path,
            args.location, args.database, args.catalog,
            partition_by={k: v.split(",") if v else [] for k, v in (x.split("=", 1) for x in args.partition_by)},
            replace=args.replace,
        )
    article = T.StructType.fromDDL(args.article) if getattr(args, "article", None) else S.ARTICLE
    if args.command == "pipeline":
        return run_location_pipeline(
            spark, args.raw_locations, args.raw_population, args.work_dir, args.database, args.catalog
        )
    if args.command == "news-load":
        return load_news(spark, args.landing, args.table, landing=args.landing_kind, article=article)
    if args.command == "news-stream":
        with packed_files(spark, args.landing_kind):
            q = start_news_stream(
                spark, args.landing, args.table, args.checkpoint, available_now=args.once,
                processing_time=args.interval, max_files_per_trigger=args.max_files_per_trigger,
                landing=args.landing_kind, article=article,
            )
            q.awaitTermination()
        if q.exception() is not None:
            raise RuntimeError(str(q.exception()))
        return None
    raise ValueError(f"unknown command {args.command!r}")


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    from geonest.session import build_session

    args = _parser().parse_args(argv)
    own = spark is None
    spark = build_session(app_name=f"geonest-{args.command}", master=args.master, spark=spark)
    try:
        result = run(args, spark)
        if result is not None:
            result.show(truncate=False)  # the first rows of the checks or rejects
        return 0
    finally:
        if own:
            spark.stop()


if __name__ == "__main__":
    sys.exit(main())
