"""Session profile (TR14) and shared scratch folders."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every pipeline relies on: UTC wall clock for stamps and date
# paths, adaptive execution for partition coalescing / skew splitting.
PROFILE = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


# Runtime settings for a large shared cluster, applied by build_session on
# a session whose master is not local, unless the submitter set them.
# Post-shuffle partitions are sized by bytes rather than spread over as
# many cores as possible. The bytes are compressed ones: rows that a task
# sorts take some 8 to 17 times as much, so 32 MiB are a few hundred MB of
# its memory and nothing spills; 256 MiB would be gigabytes.
CLUSTER_PROFILE = {
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32m",
    "spark.sql.files.maxPartitionBytes": "64m",
}


def _is_local(spark: SparkSession) -> bool:
    master = spark.sparkContext.master
    return master == "local" or master.startswith("local[")


def build_session(
    app_name: str = "geonest",
    master: str | None = None,
    conf: dict | None = None,
    spark: SparkSession | None = None,
) -> SparkSession:
    """Return a session with the profile applied.

    A session that exists already is reused; its static settings stay as
    they are, and only the runtime settings of the profile and of ``conf``
    are applied. On a cluster -- whatever named its master -- it also gets
    ``CLUSTER_PROFILE``, except where the submitter chose a value.
    """
    if spark is None:
        builder = SparkSession.builder.appName(app_name)
        if master:
            builder = builder.master(master)
        for k, v in {**PROFILE, "spark.ui.enabled": "false", **(conf or {})}.items():
            builder = builder.config(k, v)
        spark = builder.getOrCreate()
    chosen = {k for k, _ in spark.sparkContext.getConf().getAll()}
    cluster = {} if _is_local(spark) else {k: v for k, v in CLUSTER_PROFILE.items() if k not in chosen}
    for k, v in {**PROFILE, **cluster, **(conf or {})}.items():
        if spark.conf.isModifiable(k):
            spark.conf.set(k, v)
    # Listing many paths (partition folders, files a stream picks up) runs
    # as a Spark job with one task per path, up to 10,000. A few tasks per
    # core, each listing a batch of paths, finish sooner than thousands of
    # one-stat tasks; never more than Spark's own cap. Kept when the user
    # set it.
    key = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    if key not in chosen and key not in (conf or {}):
        spark.conf.set(key, str(min(10_000, max(32, 4 * spark.sparkContext.defaultParallelism))))
    return spark


#: For a write: its shuffle files go when it ends, not when the driver happens
#: to collect its garbage. Only where nobody uses the written frame again.
FREE_SHUFFLES = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


@contextmanager
def session_conf(spark: SparkSession, settings: dict[str, str]):
    """Settings that hold for the jobs started inside."""
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


_local_roots: dict[str, str] = {}


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this must be set (a machine-local folder is not visible to
    other executors). Only a local-mode session without the setting gets a
    fresh temp folder of its own, as in tests; its settings stay untouched.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not root:
        if not _is_local(spark):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        app = spark.sparkContext.applicationId
        root = _local_roots.setdefault(app, "") or tempfile.mkdtemp(prefix="geonest-ckpt-")
        _local_roots[app] = root
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def new_scratch_dir(spark: SparkSession, prefix: str) -> str:
    """The name of a fresh, never reused folder under the shared checkpoint
    root. The folder is made by whoever writes to it, in the file system
    that the path belongs to."""
    return f"{checkpoint_root(spark)}/geonest/{prefix}-{uuid.uuid4().hex[:12]}"
