"""What a running stream did, batch by batch, as a table."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

PROGRESS = (
    "run string, batch long, started timestamp, rows long, rows_per_second double, "
    "seconds double, observed map<string, string>"
)


def _observed(metrics: dict) -> dict[str, str]:
    return {
        f"{name}.{field}": str(value)
        for name, row in (metrics or {}).items()
        for field, value in row.asDict().items()
    }


def _row(progress) -> tuple:
    return (
        str(progress["runId"]),
        progress["batchId"],
        datetime.fromisoformat(progress["timestamp"].replace("Z", "+00:00")),
        progress["numInputRows"],
        progress["processedRowsPerSecond"],
        progress["durationMs"].get("triggerExecution", 0) / 1000,
        _observed(progress.get("observedMetrics")),
    )


def batches(spark: SparkSession, query: StreamingQuery) -> DataFrame:
    """One row per batch of a query that it still remembers: rows taken, rate, and
    the seconds it took, which is how far results lag behind.

    Spark keeps ``spark.sql.streaming.numRecentProgressUpdates`` batches (100).
    """
    # a batch without rows is reported more than once
    rows = {r[1]: r for r in map(_row, query.recentProgress)}
    return spark.createDataFrame([rows[b] for b in sorted(rows)], PROGRESS)
