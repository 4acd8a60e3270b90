"""Table writes and reads (S3-S9, S13-S15, U1) on path-based Parquet tables.

Tables are folders in shared storage; every read passes the declared schema,
so partition values are never re-inferred (an all-digit keyword stays a
string) and columns added later read as NULL from older files.

Full overwrites publish a new version (``versioned``). Scoped overwrite (replace
only the keyword partitions present in a batch) does so too where the table has
versions, and else uses dynamic partition overwrite on
``partitionBy(...).parquet(path)``; no SQL predicate is built from data. One table has one writer at a time, as in the reference's scheduler.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vidlens.schemas import CSV_SCHEMA, MESSAGE_FIELDS
from vidlens.session import setting, writing
from vidlens.sinks import versioned
from vidlens.sources import csv_records


def table_exists(spark: SparkSession, path: str) -> bool:
    """True when ``path`` holds a versioned table or a readable Parquet one (one footer is read)."""
    if versioned.current(spark, path) is not None:
        return True
    try:
        spark.read.parquet(path).schema
        return True
    except AnalysisException:
        return False


# ---- sources -------------------------------------------------------------------

def read_video_csv(spark: SparkSession, path: str, schema: T.StructType = CSV_SCHEMA,
                   multi_line: bool | str = True) -> DataFrame:
    """Header, multi-line quoted fields, '"' escape, declared schema; a bad
    cell becomes NULL (PERMISSIVE). With ``multi_line`` a file is one task;
    ``"parallel"`` cuts files at their record ends and reads them in many tasks
    (see ``sources.csv_records``), with the file's name in ``_source_file``;
    False, where no field holds a line feed, splits large files at lines."""
    if multi_line == "parallel":
        return csv_records.read_csv(spark, path, schema)
    return (spark.read.option("header", "true").option("multiLine", str(multi_line).lower())
            .option("escape", '"').option("mode", "PERMISSIVE").schema(schema).csv(path))


def with_audit(df: DataFrame, ingested_at: str | None = None) -> DataFrame:
    """``_ingested_at`` (run clock unless given) and ``_source_file`` (the
    file each row came from)."""
    ts = F.lit(ingested_at).cast("timestamp") if ingested_at else F.current_timestamp()
    source = F.col("_source_file") if "_source_file" in df.columns else F.col("_metadata.file_path")
    return df.select(*[c for c in df.columns if c != "_source_file"], ts.alias("_ingested_at"), source.alias("_source_file"))


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Read a whole table; a missing table is an error that names it."""
    version = versioned.current(spark, path)
    if version is not None:
        return versioned.read(spark, path, schema, version=version)
    if not table_exists(spark, path):
        raise FileNotFoundError(f"table {path} does not exist yet; run the stage that writes it first")
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    else:
        r = r.option("mergeSchema", "true")
    return r.parquet(path)


def read_csv_dir(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Every part file of a CSV output folder, header on."""
    r = spark.read.option("header", "true")
    return (r.schema(schema) if schema is not None else r).csv(path)


def union_parts(frames: Sequence[DataFrame]) -> DataFrame:
    """Concatenate frames by column name, missing columns NULL."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


# ---- sinks ---------------------------------------------------------------------

def append(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Append; new columns are read back by schema merge."""
    w = df.write.mode("append")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def rebalanced(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Rows of a partition value together, in as many tasks as their size asks for:
    few files per value, without one task for a hot value."""
    return df.hint("rebalance", *partition_by)


def overwrite(df: DataFrame, path: str, partition_by: Sequence[str] = ("keyword",)) -> None:
    """Create or fully replace a partitioned table. The old rows stay readable
    until the new ones are whole (see ``versioned``); a failed job changes nothing."""
    versioned.replace(df, path, *partition_by)


def overwrite_partitions(df: DataFrame, path: str, partition_by: Sequence[str] = ("keyword",)) -> None:
    """Replace only the partitions present in ``df``; all others stay.

    An empty batch changes nothing; a NULL key replaces only the NULL partition.
    A table that ``overwrite`` made gets a new version; other folders are
    overwritten partition by partition, which a rerun of the batch completes.
    """
    if versioned.current(df.sparkSession, path) is not None:
        versioned.replace_partitions(df, path, *partition_by)
        return
    with writing(df.sparkSession):
        (rebalanced(df, partition_by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
           .partitionBy(*partition_by).parquet(path))


def merged_schema(table: T.StructType, frame: T.StructType) -> T.StructType:
    """The table's columns in order, then the frame's new ones."""
    names = {f.name for f in table.fields}
    return T.StructType(list(table.fields) + [f for f in frame.fields if f.name not in names])


class SchemaConflict(ValueError):
    """A frame's column cannot become the table's type, nor the table's the frame's."""


#: Types that hold every value of the ones before them.
_WIDER = [[T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType()], [T.FloatType(), T.DoubleType()], [T.DateType(), T.TimestampNTZType()]]


def wider_type(a: T.DataType, b: T.DataType) -> T.DataType | None:
    """The one of two types that holds the values of both, or None."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    for chain in _WIDER:
        if a in chain and b in chain:
            return max(a, b, key=chain.index)
    if isinstance(a, T.DecimalType) and isinstance(b, T.DecimalType) and a.scale == b.scale:
        return max(a, b, key=lambda t: t.precision)
    return None


def evolved_schema(table: T.StructType, frame: T.StructType) -> T.StructType:
    """S7 over runs: the table's columns, each as wide as both sides need, then the frame's new ones. A column
    whose types do not widen into one another is refused, as reading old files or keeping new values would fail."""
    new = {f.name: f.dataType for f in frame.fields}
    out, refused = [], []
    for f in table.fields:
        kind = wider_type(f.dataType, new[f.name]) if f.name in new else f.dataType
        if kind is None:
            refused.append(f"{f.name}: {f.dataType.simpleString()} and {new[f.name].simpleString()}")
        out.append(T.StructField(f.name, kind or f.dataType))
    if refused:
        raise SchemaConflict(f"columns that do not widen: {'; '.join(refused)}")
    names = set(table.fieldNames())
    return T.StructType(out + [T.StructField(f.name, f.dataType) for f in frame.fields if f.name not in names])


def append_evolving(df: DataFrame, path: str, partition_by: str) -> T.StructType:
    """S3: append to a versioned table, whose schema grows with the frames; rows from before read new columns
    as NULL and narrower numbers as the wider type. Returns the table's schema; a refused frame changes nothing."""
    version = versioned.current(df.sparkSession, path)
    schema = evolved_schema(table_schema(version), df.schema) if version else df.schema
    versioned.append(align(df, schema), path, partition_by, {**(version.meta if version else {}), "schema": schema.jsonValue()})
    return schema


def table_schema(version: versioned.Version) -> T.StructType:
    return T.StructType.fromJson(version.meta["schema"])


def read_evolving(spark: SparkSession, path: str) -> DataFrame:
    version = versioned.current(spark, path)
    if version is None:
        raise FileNotFoundError(f"table {path} does not exist yet; run the stage that writes it first")
    return versioned.read(spark, path, table_schema(version), version=version)


def align(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Reorder ``df`` to ``schema`` by name; absent columns are typed NULLs."""
    have = set(df.columns)
    return df.select(*[(F.col(f.name).cast(f.dataType) if f.name in have
                        else F.lit(None).cast(f.dataType)).alias(f.name) for f in schema.fields])


def write_history(summary: DataFrame, path: str, run_date: str, run_ts: str | None = None) -> DataFrame:
    """Add one run's snapshot, partitioned by ``run_date``; a rerun of a date
    replaces that date's snapshot."""
    snap = (summary.withColumn("run_timestamp",
                               F.lit(run_ts).cast("timestamp") if run_ts else F.current_timestamp())
                   .withColumn("run_date", F.lit(run_date)))
    overwrite_partitions(snap, path, ["run_date"])
    return snap


def export_csv(df: DataFrame, path: str, one_file: bool = False) -> None:
    """CSV with header. ``one_file`` writes it in one task: for small summaries only."""
    ((df.coalesce(1) if one_file else df).write.mode("overwrite").option("header", "true")
       .option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false").csv(path))


#: Records of one compressed file.
RECORDS_PER_FILE = 200_000
#: For files that are read once and go.
FAST_GZIP = {"zlib.compress.level": "BEST_SPEED"}


def landing_csv(df: DataFrame, path: str) -> None:
    """The harvested records as compressed CSV with header, values kept verbatim. No file holds more than
    ``RECORDS_PER_FILE``, as one task reads it."""
    with writing(df.sparkSession):
        (df.write.mode("overwrite").option("header", "true")
           .option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false")
           .options(compression="gzip", maxRecordsPerFile=RECORDS_PER_FILE, **FAST_GZIP).csv(path))


def land_messages(messages: DataFrame, path: str, records_per_file: int | None = None, by: str | None = None) -> int:
    """Adds the messages' ``value`` to ``path`` as compressed files of lines, each task its own; returns the files there.
    A compressed file is read by one task, so none holds more than ``RECORDS_PER_FILE``. With ``by``, a column of few
    values, they go to a folder for each value, made in one pass; a file of each is open in a task."""
    most = min(records_per_file or RECORDS_PER_FILE, RECORDS_PER_FILE)
    spark = messages.sparkSession
    with writing(spark), setting(spark, "spark.sql.maxConcurrentOutputFileWriters", 16 if by else 0):
        (messages.select("value", *([by] if by else [])).write.mode("append").partitionBy(*([by] if by else []))
         .options(compression="gzip", maxRecordsPerFile=most, **FAST_GZIP).text(path))
    return 0 if by else versioned.data_files(spark, path)


def to_messages(df: DataFrame, key: str = "video_id", fields: Sequence[str] = MESSAGE_FIELDS) -> DataFrame:
    """One keyed JSON message per record (``key`` binary, ``value`` text)."""
    return df.select(F.col(key).cast("binary").alias("key"),
                     F.to_json(F.struct(*[F.col(c) for c in fields])).alias("value"))


def send_messages(messages: DataFrame, bootstrap: str, topic: str, **options: str) -> None:
    """``to_messages`` rows to a broker's topic; a key's messages share a partition, each is acknowledged by
    all replicas. Needs the Kafka connector on the classpath."""
    settings = {"kafka.bootstrap.servers": bootstrap, "topic": topic, "kafka.acks": "all", **options}
    messages.select("key", "value").write.format("kafka").options(**settings).save()
