"""Helpers shared by the operators: column picks, splits, written tables."""

from __future__ import annotations

import contextlib
import ctypes
import functools
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from geonest.session import new_scratch_dir

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def pick(df: DataFrame, **cols: str) -> DataFrame:
    """Only the named columns, under fixed names and types; any extra column
    of the input (whatever its name) stays out of the operator."""
    return df.select(*[df[src].cast(kind).alias(out) for out, (src, kind) in
                       ((k, v.split(":")) for k, v in cols.items())])


def text_bytes(col: Column | str) -> Column:
    """The UTF-8 bytes of a text; null counts as empty."""
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit("")).cast("binary")


def id_remainder(doc_id: Column | str, modulus: int) -> Column:
    """crc32 of the decimal id, modulo ``modulus`` (null for a null id)."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(c.cast("string").cast("binary")) % modulus


def write_table(df: DataFrame, name: str, options: dict[str, str] | None = None) -> DataFrame:
    """``df`` written to a fresh folder under ``spark.checkpoint.dir`` and
    read back: cuts the lineage with files every executor can reach.
    ``options`` are the Parquet writer's."""
    spark = df.sparkSession
    path = f"{new_scratch_dir(spark, name)}/t.parquet"
    df.write.options(**options or {}).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def binary_list(values: pa.Array) -> list[bytes]:
    """The items of a (large) binary array without nulls, cut from one copy:
    several times as fast as ``to_pylist``."""
    kind = "<i8" if pa.types.is_large_binary(values.type) else "<i4"
    ends = np.frombuffer(values.buffers()[1], kind)[values.offset:values.offset + len(values) + 1].tolist() if len(values) else [0]
    data = values.buffers()[2]
    data = data.slice(ends[0], ends[-1] - ends[0]).to_pybytes() if data is not None else b""
    return [data[a - ends[0]:b - ends[0]] for a, b in zip(ends, ends[1:], strict=False)]


def release_shuffles(spark: SparkSession) -> None:
    """Let the shuffle files of finished jobs go now. Spark removes them once
    the driver's JVM has collected the jobs' objects, which on a large heap
    may be long after a written table has made them useless."""
    spark.sparkContext._jvm.java.lang.System.gc()


def give_back() -> None:
    """Return a Python worker's freed memory to the system. Spark keeps idle
    workers, and an executor's limit counts what they hold on to."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


_STATE: dict[tuple, object] = {}


def worker_state(module: str, key, make: Callable):
    """What ``module`` keeps in a Python worker from task to task: the result
    of ``make`` the first time. It goes when the worker, which Spark reuses,
    runs a ``tidy`` task of another module."""
    if (module, key) not in _STATE:
        _STATE[module, key] = make()
    return _STATE[module, key]


def drop_state(but: str) -> None:
    """Let the state of all modules go but of that one."""
    for k in [k for k in _STATE if k[0] != but]:
        del _STATE[k]


def tidy(factory: Callable) -> Callable:
    """For functions that return a ``mapInArrow`` function: a task first drops
    the state of other modules in its worker, and gives freed memory back at
    its end. Stages of a long job run in the same workers, which would
    hold the most that each of the stages took."""
    module = factory.__module__

    @functools.wraps(factory)
    def make(*args, **kwargs):
        run = factory(*args, **kwargs)

        def tidied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            drop_state(module)
            yield from run(batches)
            give_back()

        return tidied

    return make


#: Rows of an Arrow batch where rows are whole texts (Spark's own number is 10,000).
BATCH_ROWS = 2048
#: And its bytes, about: an executor's JVM keeps buffers of that size outside its heap.
BATCH_BYTES = 2 << 20


def small_batches(spark: SparkSession) -> None:
    """From now on the session hands Python workers ``BATCH_ROWS`` rows or
    about ``BATCH_BYTES`` at once, unless the submitter chose a number."""
    chosen = {k for k, _ in spark.sparkContext.getConf().getAll()}
    for key, most in (("maxRecordsPerBatch", BATCH_ROWS), ("maxBytesPerBatch", BATCH_BYTES)):
        if f"spark.sql.execution.arrow.{key}" not in chosen:
            spark.conf.set(f"spark.sql.execution.arrow.{key}", str(most))


@contextlib.contextmanager
def handing_over(spark: SparkSession, most: int) -> Iterator[None]:
    """Jobs run inside hand Python workers batches of about ``most`` bytes at
    most, where rows are whole texts."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key, None)
    spark.conf.set(key, str(most))
    try:
        yield
    finally:
        spark.conf.set(key, before) if before is not None else spark.conf.unset(key)


def size_of(df: DataFrame, text: str = "text") -> tuple[int, int]:
    """Rows and text bytes of a table (one aggregated row)."""
    r = df.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length(text)).alias("b")).first()
    return int(r["n"]), int(r["b"] or 0)


WORD_SPACE = re.compile(rb"[\x20\x09-\x0d]+")


def words(text: bytes) -> list[bytes]:
    r"""Lower-cased (A-Z) words ``[^\x20\x09-\x0D]+`` of a text: ``bytes``
    methods lower and split on exactly these ASCII characters."""
    return text.lower().split()
