"""Scoring a live feed: parse, feature, score, write. No state and no shuffle;
the operators are the ones the batch job uses."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import or_

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from punctual.operators.features import cast_numeric, prepare
from punctual.operators.learning import DelayModel, scored_rows
from punctual.schema import COLUMNS, NUMERIC_FEATURES, text_schema
from punctual.sources.feed import kafka_sink_options
from punctual.settings import DEFAULTS, Settings


def parse_records(records: DataFrame) -> DataFrame:
    """Flights from JSON values.

    Fields are read as text and then cast, which takes numbers written with
    and without quotes. A value that is no JSON gives an all-NULL row;
    ``checked_records`` tells it apart.
    """
    data = F.from_json(F.col("value").cast("string"), text_schema())
    return cast_numeric(records.select(data.alias("data")).select("data.*"))


#: Column of a parsed record that holds the text of an unreadable one.
_RAW = "__raw"


def checked_records(records: DataFrame) -> DataFrame:
    """Flights from JSON values with ``rejected_value``: the text of a message that
    is no JSON object, NULL for good ones; ``rejected`` says which are which (a
    missing value is rejected as well). One parse serves both."""
    value = F.col("value").cast("string")
    schema = text_schema().add(_RAW, "string")
    data = F.from_json(value, schema, {"columnNameOfCorruptRecord": _RAW})
    parsed = records.select(value.alias("value"), data.alias("data"))
    bad = (
        F.col("data").isNull()
        | F.col(f"data.{_RAW}").isNotNull()
        # JSON that is no object: a list, a number, a text
        | ~F.coalesce(F.ltrim("value").startswith("{"), F.lit(False))
    )
    flat = parsed.select(
        *[F.col(f"data.{c}").alias(c) for c in COLUMNS],
        F.when(bad, F.col("value")).alias("rejected_value"),
        bad.alias("rejected"),
    )
    return cast_numeric(flat)


def watched(flights: DataFrame, name: str = "feed") -> DataFrame:
    """``flights`` (prepared, from a feed), counting on the way: rows, those that
    could not be read, and those that scoring will skip for a missing number. The
    counts come with the progress of each batch, without another pass."""
    missing = reduce(or_, [F.col(c).isNull() for c in NUMERIC_FEATURES])
    return flights.observe(
        name,
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("flight_id").isNull()).alias("unreadable"),
        F.count_if(missing).alias("skipped"),
    )


def score_records(records: DataFrame, model: DelayModel) -> DataFrame:
    """Scored flights from a feed."""
    return scored_rows(model.score(watched(prepare(parse_records(records)))))


def write_stream(
    df: DataFrame,
    checkpoint: str,
    kind: str = "console",
    path: str | None = None,
    interval: str | None = None,
    once: bool = False,
    settings: Settings = DEFAULTS,
) -> StreamingQuery:
    """Start an append-mode query.

    ``checkpoint`` is a folder of this query alone; restarting with it resumes
    where the last run stopped. ``once`` handles what has arrived and ends,
    otherwise a batch starts at every ``interval``.
    """
    writer = df.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
    if kind == "console":
        writer = writer.format("console").option("truncate", "false").option("numRows", 20)
    elif kind == "parquet":
        writer = writer.format("parquet").option("path", path)
    elif kind == "kafka":
        writer = writer.format("kafka").options(**kafka_sink_options(settings))
    else:
        raise ValueError(f"unknown kind of sink: {kind}")
    if once:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=interval or settings.trigger_interval).start()


def run(query: StreamingQuery, follow: bool = True) -> None:
    """Wait for the query; stop it however the wait ends. Without ``follow`` the
    wait ends when all that had arrived is handled, at the query's own pace."""
    try:
        if follow:
            query.awaitTermination()
        else:
            query.processAllAvailable()
    finally:
        query.stop()


# ---- batches written once -------------------------------------------------------


class Ledger:
    """Output of a stream in one folder per batch, and the batches that are done.

    A batch is written under its number and only then entered. A batch that fails
    anywhere on the way is replayed under the same number: it replaces what it
    left behind, and nothing if it was entered already. Readers take entered
    batches only, so every row counts once.
    """

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")

    def _data(self, batch: int, part: str) -> str:
        return f"{self.path}/{part}/batch={batch}"

    def entered(self, batch: int) -> bool:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/entered/batch={batch}/_SUCCESS")
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path)

    def write(self, parts: dict[str, DataFrame], batch: int) -> None:
        """Write the tables of a batch, then enter it."""
        if self.entered(batch):
            return
        for name, part in parts.items():
            part.write.mode("overwrite").parquet(self._data(batch, name))
        entry = self.spark.range(1).select(F.lit(batch).cast("long").alias("number"))
        entry.write.mode("overwrite").parquet(f"{self.path}/entered/batch={batch}")

    def read(self, part: str = "rows") -> DataFrame:
        """Rows of all entered batches."""
        done = self.spark.read.parquet(f"{self.path}/entered").select("number").distinct()
        rows = self.spark.read.parquet(f"{self.path}/{part}")
        return rows.join(done, F.col("batch") == F.col("number"), "left_semi").drop("batch")


def write_once(
    df: DataFrame,
    checkpoint: str,
    ledger: Ledger,
    split: Callable[[DataFrame], dict[str, DataFrame]] = lambda rows: {"rows": rows},
    interval: str | None = None,
    settings: Settings = DEFAULTS,
) -> StreamingQuery:
    """Start a query whose batches go through a ledger. ``split`` makes the tables
    of a batch; the batch is kept while they are written. Without an interval it
    handles what has arrived and ends."""

    def handle(rows: DataFrame, batch: int) -> None:
        kept = rows.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            ledger.write(split(kept), batch)
        finally:
            kept.unpersist()

    writer = df.writeStream.option("checkpointLocation", checkpoint).foreachBatch(handle)
    if interval is None:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=interval).start()


def good_and_rejected(rows: DataFrame) -> dict[str, DataFrame]:
    """A batch of checked records as two tables: flights, and texts no one can read."""
    return {
        "rows": rows.where(~F.col("rejected")).select(*COLUMNS),
        "rejects": rows.where("rejected").select("rejected_value"),
    }
