"""Scalar column functions (FN1-FN12), all built-in expressions."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from geonest import constants as K


def to_float(c: Column | str) -> Column:
    """FN1: text to 32-bit float; malformed or empty text becomes null.

    ``try_cast`` keeps the non-ANSI semantics of the original job on a
    session with ANSI mode on, where a plain cast would fail the job.
    """
    c = F.col(c) if isinstance(c, str) else c
    return c.try_cast("float")


def source_timestamp(ts: str = K.POPULATION_SOURCE_TIMESTAMP) -> Column:
    """FN2: a constant timestamp literal."""
    return F.to_timestamp(F.lit(ts))


def run_stamp(run_ts: str | _dt.datetime | None = None) -> Column:
    """FN3: the load time of a run.

    With ``run_ts`` the value is a literal, so every table of one run (and
    every re-execution after an executor loss) carries the same stamp;
    without it ``current_timestamp()``, which is fixed within a query.
    """
    if run_ts is None:
        return F.current_timestamp()
    return F.lit(run_ts).cast("timestamp")


_DAY = 86_400_000_000


def _utc_micros(ts: Column | str) -> Column:
    """Microseconds since 1970 in UTC, whatever the session's time zone; a
    timestamp without a zone counts as UTC."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    wall = F.concat(ts.cast("timestamp_ntz").cast("string"), F.lit("Z")).cast("timestamp")
    return F.unix_micros(F.when(F.typeof(ts) == "timestamp_ntz", wall).otherwise(ts.cast("timestamp")))


def _utc_wall(ts: Column | str) -> Column:
    """The UTC wall clock of a timestamp as text, ``yyyy-MM-dd HH:mm:ss`` and a
    fraction where there is one; in whole microseconds throughout."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_add("MICROSECOND", _utc_micros(ts), epoch).cast("string")


def utc_date(ts: Column | str) -> Column:
    """The UTC date of a timestamp as ``yyyy-MM-dd``."""
    micros = _utc_micros(ts)
    day = F.call_function("div", micros - F.pmod(micros, F.lit(_DAY)), F.lit(_DAY)).cast("int")
    return F.date_from_unix_date(day).cast("string")


def date_path(ts: Column | str) -> Column:
    """FN5: the UTC date of a timestamp as a ``yyyy/MM/dd`` path segment."""
    return F.replace(utc_date(ts), F.lit("-"), F.lit("/"))


def iso_utc(ts: Column | str) -> Column:
    """FN6: a timestamp in UTC as an ISO-8601 string with a ``Z`` suffix."""
    wall = F.replace(_utc_wall(ts), F.lit(" "), F.lit("T"))
    # seconds end the text, or a fraction without its last zeros does
    tail = F.substring_index(wall, ":", -1)
    whole = F.when(F.instr(tail, ".") == 0, F.concat(wall, F.lit(".000000"))).otherwise(F.concat(wall, F.repeat(F.lit("0"), 9 - F.length(tail))))
    return F.concat(whole, F.lit("Z"))


def quoted(c: Column | str) -> Column:
    """FN7: wrap a phrase in double quotes (exact-phrase search)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.concat(F.lit('"'), c, F.lit('"'))


def form_encode(value: Column) -> Column:
    """Form-encode a value like the original request builder: space as
    ``+``, and only letters, digits and ``_.-~`` left as they are. Spark's
    encoder also leaves ``*`` and encodes ``~``, so those two are swapped
    back."""
    enc = F.url_encode(value.cast("string"))
    return F.replace(F.replace(enc, F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def _param(name: str, value: Column) -> Column:
    return F.concat(F.lit(name + "="), form_encode(value))


def request_query_string(
    q: Column,
    lang: Column,
    countries: Column,
    topic: Column,
    sort_by: Column | None = None,
    page_size: Column | None = None,
    page: Column | None = None,
) -> Column:
    """FN8: form-encoded request parameters in the request's key order."""
    sort_by = F.lit(K.NEWS_SORT_BY) if sort_by is None else sort_by
    page_size = F.lit(K.NEWS_PAGE_SIZE) if page_size is None else page_size
    page = F.lit(K.NEWS_FIRST_PAGE) if page is None else page
    return F.concat_ws(
        "&",
        _param("q", q),
        _param("lang", lang),
        _param("countries", countries),
        _param("topic", topic),
        _param("sort_by", sort_by),
        _param("page_size", page_size),
        _param("page", page),
    )


def news_storage_path(
    ts: Column | str,
    country: Column | str,
    topic: Column | str,
    api_name: str = K.NEWS_API_NAME,
    file_name: str = K.NEWS_FILE_NAME,
) -> Column:
    """FN9: ``<api>/<yyyy/MM/dd>/<country>/<topic>/<file>``."""
    country = F.col(country) if isinstance(country, str) else country
    topic = F.col(topic) if isinstance(topic, str) else topic
    return F.concat_ws("/", F.lit(api_name), date_path(ts), country, topic, F.lit(file_name))
