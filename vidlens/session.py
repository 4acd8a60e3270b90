"""Session construction and cluster-shared locations.

Library functions never build a session; they take the caller's. ``get_session``
is for tests, the bench and command-line use.
"""

from __future__ import annotations

import contextlib
import functools
import os
import re
import tempfile

from pyspark.sql import SparkSession

# Settings we rely on. AQE stays on (runtime coalescing, skew-join splitting,
# broadcast conversion from measured sizes); the reference switched it off for
# a table-format bug that does not apply to Parquet.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Static mode for ordinary overwrites; scoped writes pass the dynamic
    # option on the writer (see vidlens.sinks.tables).
    "spark.sql.sources.partitionOverwriteMode": "static",
}

# Settings every job here relies on; all but the last change how work is
# spread, never results. Without the first, an aggregate on (keyword, id) or
# a window on (keyword, bucket) may reuse an upstream partitioning on keyword
# alone, and a hot keyword would run whole in one task.
PLAN_CONF = {
    "spark.sql.requireAllClusterKeysForDistribution": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A task sorts the rows of its split (partial group limits of de-duplication) and they are many times the size
    # of the file's bytes: splits small enough to be sorted in memory, whatever the file's size.
    "spark.sql.files.maxPartitionBytes": "16m",
    # This one does change results: years, months and ages are those of UTC, whatever zone the caller's session has.
    "spark.sql.session.timeZone": "UTC",
}
DEFAULT_CONF.update(PLAN_CONF)


def apply_plan_defaults(spark: SparkSession) -> SparkSession:
    """Set ``PLAN_CONF`` on a session the caller built."""
    for k, v in PLAN_CONF.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    return spark


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "vidlens", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Where the setting is absent, a run on one machine (master ``local``) gets
    one private folder per application; anything else is refused, as executors
    would each write to their own disk.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path:
        return path
    context = spark.sparkContext
    return local_scratch(context.master, context.applicationId)


@functools.lru_cache(maxsize=None)
def local_scratch(master: str, application: str) -> str:
    if not re.fullmatch(r"local(\[.*\])?", master):
        raise RuntimeError(f"spark.checkpoint.dir is not set; master {master!r} needs a folder that all machines share")
    return tempfile.mkdtemp(prefix="vidlens-ckpt-")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint dir for written intermediate tables."""
    return os.path.join(checkpoint_dir(spark), name)


#: Where true, a job's shuffle files go as soon as it ends. For steps whose results are all written.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextlib.contextmanager
def setting(spark: SparkSession, key: str, value):
    """Jobs run inside have this setting."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, str(value).lower())
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def writing(spark: SparkSession):
    """A write inside leaves no shuffle files behind: else those of all steps lie there until the driver happens to
    collect its garbage."""
    return setting(spark, SHUFFLE_CLEANUP, True)


def materialize(df, name: str):
    """Write ``df`` as Parquet to a fresh folder under the shared checkpoint
    location and return it read back: cuts the lineage where a result is read
    several times, and survives lost executors (unlike a cache)."""
    import uuid
    spark = df.sparkSession
    path = scratch_path(spark, f"vidlens-{name}-{uuid.uuid4().hex}")
    with writing(spark):
        df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(*written) -> None:
    """Delete the folders that ``materialize`` wrote for these, which no later job reads."""
    for df in written:
        folders = {f.rsplit("/", 1)[0] for f in df.inputFiles()}
        for folder in folders:
            if not re.search(r"/vidlens-[^/]+-[0-9a-f]{32}$", folder):
                raise ValueError(f"{folder} is no intermediate table")
            path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)
