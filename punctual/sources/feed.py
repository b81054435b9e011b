"""The message feed: keyed JSON records over a broker, or over files that carry
the same key and value columns where no broker is at hand."""

from __future__ import annotations

from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from punctual.settings import DEFAULTS, Settings

RECORD_SCHEMA = StructType([StructField("key", StringType()), StructField("value", StringType())])

# Delivery guarantees of the broker writer.
DELIVERY = {
    "kafka.acks": "all",
    "kafka.retries": "3",
    "kafka.batch.size": "16384",
    "kafka.linger.ms": "10",
}

# The file twin packs well, as every message repeats its field names,
# and its row groups are small, so that a batch of few files is read by many tasks.
FILE_TWIN = {"compression": "zstd", "parquet.block.size": str(8 * 1024 * 1024)}

# Fixed value: key of records that have no origin column.
UNKNOWN_KEY = "UNKNOWN"


def record_key(df: DataFrame, column: str = "origin") -> Column:
    """Partition key: the origin; an empty one is NULL, a missing column UNKNOWN."""
    if column not in df.columns:
        return F.lit(UNKNOWN_KEY)
    return F.nullif(F.col(column), F.lit(""))


def keyed_records(df: DataFrame, max_records: int | None = None) -> DataFrame:
    """Rows as (key, JSON value), every field as text, as in the raw feed.

    ``max_records`` of None or 0 means all of them.
    """
    rows = capped(df, max_records) if max_records else df
    fields = F.struct(*[F.col(c).cast("string").alias(c) for c in df.columns])
    value = F.to_json(fields, {"ignoreNullFields": "false"})
    return rows.select(record_key(df).alias("key"), value.alias("value"))


def _positions(df: DataFrame) -> DataFrame:
    """``df`` with ``__file``, ``__start`` and ``__place``: rows by file, by the
    byte where their split of it begins, and by a number that rises within it.

    A split is read by one task from front to back, whatever other splits that
    task reads, so places are contiguous in it. Rows that come from no file are
    told by their partition instead.
    """
    place = F.monotonically_increasing_id().alias("__place")
    try:
        named = df.select(
            "*",
            F.col("_metadata.file_path").alias("__file"),
            F.col("_metadata.file_block_start").alias("__start"),
        )
    except AnalysisException:
        part = F.shiftright(F.monotonically_increasing_id(), 33)
        named = df.select("*", F.lit("").alias("__file"), part.alias("__start"))
    return named.select("*", place)


def capped(df: DataFrame, most: int) -> DataFrame:
    """The first ``most`` rows in the order of the files' names and of the rows in
    them, however Spark packs files into tasks.

    Rows are counted per split; a table of one row per split sums up how many lie
    ahead of it. Each split then keeps its part of the cap: no row moves, and
    nothing is collected. Only the splits that keep rows are looked up, in a table
    of at most one row per split that goes to all tasks: joined otherwise, every
    row would be shuffled before the size of that table is known.
    """
    rows = _positions(df)
    per_split = rows.groupBy("__file", "__start").agg(
        F.count("*").alias("n"), F.min("__place").alias("first")
    )
    ahead = Window.orderBy("__file", "__start").rowsBetween(Window.unboundedPreceding, -1)
    quotas = (
        per_split.withColumn("before", F.coalesce(F.sum("n").over(ahead), F.lit(0)))
        .where(F.col("before") < most)
        .select(
            F.col("__file").alias("__of_file"),
            F.col("__start").alias("__of_start"),
            (F.col("first") + F.lit(most) - F.col("before")).alias("__stop"),
        )
    )
    mine = (F.col("__file") == F.col("__of_file")) & (F.col("__start") == F.col("__of_start"))
    kept = rows.join(F.broadcast(quotas), mine)
    return kept.where(F.col("__place") < F.col("__stop")).select(*df.columns)


def kafka_source_options(
    settings: Settings = DEFAULTS,
    starting_offsets: str = "latest",
    fail_on_data_loss: bool = False,
    max_offsets_per_trigger: int | None = None,
    min_partitions: int | None = None,
) -> dict[str, str]:
    """Options of the broker source.

    Records are keyed by origin, so a busy hub fills one broker partition;
    ``min_partitions`` lets Spark read such a partition in several tasks.
    """
    options = {
        "kafka.bootstrap.servers": settings.servers,
        "subscribe": settings.topic,
        "startingOffsets": starting_offsets,
        "failOnDataLoss": str(fail_on_data_loss).lower(),
    }
    if max_offsets_per_trigger:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    if min_partitions:
        options["minPartitions"] = str(min_partitions)
    return options


def kafka_sink_options(settings: Settings = DEFAULTS) -> dict[str, str]:
    return {
        "kafka.bootstrap.servers": settings.servers,
        "topic": settings.topic,
        **DELIVERY,
    }


def records_per_trigger(
    interval_seconds: float, batch_size: int = 100, delay_seconds: float = 0.1
) -> int:
    """Records one trigger may take to keep the pace of ``batch_size`` records
    every ``delay_seconds``."""
    return max(1, round(batch_size * interval_seconds / delay_seconds))


def read_records(
    spark: SparkSession,
    kind: str = "kafka",
    path: str | None = None,
    settings: Settings = DEFAULTS,
    max_files_per_trigger: int | None = None,
    since: datetime | None = None,
    archive: str | None = None,
    **kafka,
) -> DataFrame:
    """A stream of records with columns key and value.

    ``kind`` is ``kafka`` or ``files`` (a folder of Parquet files). Of files,
    ``since`` takes only those delivered after that moment, as a broker's latest
    offsets do: note it at the first start, and pass the same one when resuming.
    ``archive`` is a folder that finished files move to, the file twin of
    retention.
    """
    if kind == "kafka":
        options = kafka_source_options(settings, **kafka)
        return spark.readStream.format("kafka").options(**options).load()
    if kind == "files":
        reader = spark.readStream.schema(RECORD_SCHEMA)
        if max_files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
        if archive:
            reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
        records = reader.parquet(path)
        if since is None:
            return records
        delivered = F.col("_metadata.file_modification_time")
        return records.where(delivered > F.lit(since)).select(*RECORD_SCHEMA.names)
    raise ValueError(f"unknown kind of feed: {kind}")


def stage_records(records: DataFrame, path: str, per_file: int) -> None:
    """Records as files of at most ``per_file`` each, to be sent file by file."""
    records.write.option("maxRecordsPerFile", per_file).parquet(path)


def send_records(
    records: DataFrame,
    kind: str = "kafka",
    path: str | None = None,
    settings: Settings = DEFAULTS,
) -> None:
    """Deliver a bounded set of records in one job; a failure propagates."""
    if kind == "kafka":
        records.write.format("kafka").options(**kafka_sink_options(settings)).save()
    elif kind == "files":
        records.write.mode("append").options(**FILE_TWIN).parquet(path)
    else:
        raise ValueError(f"unknown kind of feed: {kind}")
