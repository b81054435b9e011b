"""Bounded sources and sinks: CSV and Parquet."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from punctual.schema import text_schema, typed_schema

# Quotes are doubled inside quoted fields and blanks kept, as the common CSV
# writers do it; Spark's own defaults differ.
_CSV = {
    "header": "true",
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def _header(spark: SparkSession, path: str, **options: str) -> list[str]:
    """Column names from the first line; reads one file's head, infers nothing."""
    return spark.read.options(**{**_CSV, **options}).csv(path).columns


def _read(spark: SparkSession, path: str, schema: StructType, **options: str) -> DataFrame:
    # enforceSchema=false makes Spark compare the header of every file with
    # the schema instead of assigning columns by position.
    chosen = {**_CSV, "enforceSchema": "false", **options}
    return spark.read.schema(schema).options(**chosen).csv(path)


def read_flights_csv(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """Flights from CSV, columns matched by header name and typed explicitly.

    Columns may come in any order and may be missing. Unreadable numbers
    become NULL.
    """
    return _read(spark, path, typed_schema(_header(spark, path, **options)), **options)


def read_feed_csv(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """Every column as text, empty fields as empty strings: the raw feed."""
    return _filled(_read(spark, path, text_schema(_header(spark, path, **options)), **options))


def _filled(rows: DataFrame) -> DataFrame:
    return rows.select([F.coalesce(F.col(f"`{n}`"), F.lit("")).alias(n) for n in rows.columns])


def stream_feed_csv(
    spark: SparkSession, folder: str, max_files_per_trigger: int | None = None, **options: str
) -> DataFrame:
    """The raw feed as a stream of the folder's CSV files, as they arrive.

    ``max_files_per_trigger`` with the interval of the query sets the pace.
    """
    limits = {"maxFilesPerTrigger": str(max_files_per_trigger)} if max_files_per_trigger else {}
    chosen = {**_CSV, "enforceSchema": "false", **limits, **options}
    schema = text_schema(_header(spark, folder, **options))
    return _filled(spark.readStream.schema(schema).options(**chosen).csv(folder))


def write_flights_csv(
    df: DataFrame, path: str, mode: str = "errorifexists", **options: str
) -> None:
    df.write.mode(mode).options(**{**_CSV, **options}).csv(path)


def read_flights_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Columnar flights: filters and column choice reach the files."""
    return spark.read.parquet(path)


def write_flights_parquet(
    df: DataFrame, path: str, partition_by: tuple[str, ...] = (), mode: str = "errorifexists"
) -> None:
    df.write.mode(mode).partitionBy(*partition_by).parquet(path)
