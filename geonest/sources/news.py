"""Landed news responses and the written news table (SC6, SC7)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from geonest import schemas as S
from geonest.sinks.commit_log import CommitLog


def read_response_log(spark: SparkSession, path: str, schema: T.StructType = S.RESPONSE_ENVELOPE) -> DataFrame:
    """SC6: landed responses as JSON lines, one request per line
    (``country, topic, page, requested_at, body``). Splittable. A line that
    is no such envelope keeps its text in ``corrupt_line``."""
    return _log_options(spark.read, schema).json(path)


def stream_response_log(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """The same landing as a streaming source: each file is picked up once."""
    reader = _log_options(spark.readStream, S.RESPONSE_ENVELOPE)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.json(path)


def _log_options(reader, schema: T.StructType):
    schema = T.StructType([*schema.fields, T.StructField("corrupt_line", T.StringType())])
    return reader.schema(schema).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "corrupt_line")


# The two folders above a landed file: ``<country>/<topic>/`` or the Hive
# form ``country=<c>/topic=<t>/``.
_FILE_KEYS = r"([^/]+)/([^/]+)/[^/]+$"
_HIVE_NULL = "__HIVE_DEFAULT_PARTITION__"


def folder_value(name: Column) -> Column:
    """The value that a folder of a file URI stands for: the URI's escapes are
    taken off, and in the Hive form ``key=value`` also the key and the
    value's own escapes; the name for null is null."""
    plain = _unescape(name)
    key = F.regexp_extract(plain, r"^[^=]+=(.*)$", 1)
    hive = F.when(key == _HIVE_NULL, F.lit(None).cast("string")).otherwise(_unescape(key))
    return F.when(plain.rlike(r"^[^=]+="), hive).otherwise(plain)


def _unescape(c: Column) -> Column:
    # url_decode would read + as a space; a % that begins no escape stays
    safe = F.regexp_replace(F.replace(c, F.lit("+"), F.lit("%2B")), r"%(?![0-9A-Fa-f]{2})", "%25")
    return F.url_decode(safe)


#: Files of a per-file landing that are planned at once: the driver holds about
#: a kilobyte of each, and a group's staged rows go before the next is read.
GROUP_FILES = 1 << 16


def landing_groups(spark: SparkSession, path: str, most: int = GROUP_FILES) -> list[list[str]]:
    """The folders of a per-file landing in groups of about ``most`` files, or of
    one folder that has more. Together they are all that reading ``path`` reads."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    root = hadoop(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return [[path]]  # a pattern, or the reader's error
    groups, room = [], 0

    def add(folder, count: int) -> None:
        nonlocal room
        if not groups or count > room:
            groups.append([])
            room = most
        groups[-1].append(folder.toString())
        room -= count

    def walk(folder, count: int) -> None:
        below = fs.listStatus(folder) if count > most else []
        if not below or not all(s.isDirectory() for s in below):
            add(folder, count)
            return
        for status in sorted(below, key=lambda s: s.getPath().toString()):
            name = status.getPath().getName()
            # as Spark's readers pass over them
            if not name.startswith(".") and ("=" in name or not name.startswith("_")):
                walk(status.getPath(), fs.getContentSummary(status.getPath()).getFileCount())

    walk(root, fs.getContentSummary(root).getFileCount())
    pattern = any(set("{}[]^*?\\") & set(folder) for group in groups for folder in group)  # to a reader
    return [[path]] if pattern or len(groups) < 2 else groups


def read_response_files(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """SC6 for one-body-per-file landings laid out as
    ``.../<country>/<topic>/<file>`` (or ``country=/topic=`` folders): the
    body is the whole file and the request keys come from the file path.

    Small files are packed several to a task by the file source, so many
    landed responses do not mean as many tasks. ``wholetext`` is passed to
    ``text()`` itself: its default would override an ``option()`` and
    split bodies at newlines. A 0-byte file is invisible to Spark's file
    sources (it has no split), so a loader must not land an empty body as
    an empty file."""
    return _response_file_keys(spark.read.text(path, wholetext=True, recursiveFileLookup=True))


def stream_response_files(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """SC6 one-body-per-file landing as a streaming source: each file is
    picked up once (tracked by the query's checkpoint)."""
    reader = spark.readStream
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return _response_file_keys(reader.text(path, wholetext=True, recursiveFileLookup=True))


def _response_file_keys(df: DataFrame) -> DataFrame:
    fp = F.col("_metadata.file_path")
    return df.select(
        folder_value(F.regexp_extract(fp, _FILE_KEYS, 1)).alias("country"),
        folder_value(F.regexp_extract(fp, _FILE_KEYS, 2)).alias("topic"),
        F.col("value").alias("body"),
    )


def load_folder(table_path: str, load: str) -> str:
    """The folder of one load of a news table. A load's files are its own, so
    batch loads and streams can share a table."""
    return f"{table_path.rstrip('/')}/load={load}"


def rejects_path(table_path: str) -> str:
    """Folder of the rejected responses of a news table."""
    return f"{table_path.rstrip('/')}-rejects"


def read_loads(spark: SparkSession, table_path: str) -> list[str] | None:
    """The loads of a news table that count; None for a table without a log."""
    log = CommitLog(spark, table_path)
    return log.loads() if log.exists() else None


def read_news_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """SC7: the partitioned news table (``load=/date=/country=/topic=``, as
    written by the batch load and the stream; the load folder is no column
    of the result). Only loads that are committed when this is called are
    read; of a table without a log, all of them.

    With a schema the partition values keep their text type (otherwise
    ``2024-01-01`` would be read as a date and ``01`` as an integer)."""
    loads = read_loads(spark, path)
    return _read_loads(spark, path, loads, schema)


def _read_loads(spark: SparkSession, path: str, loads: list[str] | None, schema: T.StructType | None) -> DataFrame:
    reader = spark.read
    if schema is not None:
        reader = reader.schema(T.StructType([*schema.fields, T.StructField("load", T.StringType())]))
    if loads is None:
        return reader.parquet(path).drop("load")
    if not loads:
        if schema is None:
            raise ValueError(f"{path} has no committed load yet; pass a schema to read it as empty")
        return spark.createDataFrame([], schema)
    return reader.option("basePath", path).parquet(*(load_folder(path, x) for x in loads)).drop("load")


def read_news_rejects(spark: SparkSession, table_path: str, loads: list[str] | None = None) -> DataFrame:
    """The rejected responses (FI2) of the committed loads of a news table, or of those named."""
    loads = loads if loads is not None else read_loads(spark, table_path)
    root = rejects_path(table_path)
    if not loads:
        raise ValueError(f"{table_path} has no committed load yet")
    return spark.read.option("basePath", root).option("mergeSchema", True).parquet(*(load_folder(root, x) for x in loads)).drop("load")


def read_news_layout(spark: SparkSession, path: str) -> DataFrame:
    """SC7 for the plain ``<api>/<yyyy>/<MM>/<dd>/<country>/<topic>/<file>``
    layout: keys are parsed from each file path."""
    df = spark.read.option("recursiveFileLookup", True).parquet(path)
    fp = F.col("_metadata.file_path")
    pat = r"(\d{4})/(\d{2})/(\d{2})/([^/]+)/([^/]+)/[^/]+$"
    return df.select(
        "*",
        F.concat_ws(
            "-", F.regexp_extract(fp, pat, 1), F.regexp_extract(fp, pat, 2), F.regexp_extract(fp, pat, 3)
        ).alias("date"),
        folder_value(F.regexp_extract(fp, pat, 4)).alias("country"),
        folder_value(F.regexp_extract(fp, pat, 5)).alias("topic"),
    )
