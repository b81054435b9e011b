"""Row-wise operators shared by batch and stream: features, casts, row checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from punctual.functions import parsing
from punctual.schema import NUMERIC_COLUMNS, NUMERIC_FEATURES


def add_time_features(df: DataFrame) -> DataFrame:
    """Turn ``date`` into a date and add weekday (1 = Sunday), month, departure
    hour and minute. Unreadable text gives NULL."""
    if isinstance(df.schema["date"].dataType, StringType):
        df = df.withColumn("date", parsing.flight_date(F.col("date")))
    departure = F.col("scheduled_departure")
    return df.withColumns(
        {
            "day_of_week": F.dayofweek("date"),
            "month": F.month("date"),
            "scheduled_departure_hour": parsing.clock_part(departure, 0),
            "scheduled_departure_minute": parsing.clock_part(departure, 1),
        }
    )


def cast_numeric(df: DataFrame, columns: Sequence[str] = NUMERIC_COLUMNS) -> DataFrame:
    """Read the number columns that exist as doubles; columns that are doubles
    already stay untouched, so that filters on them still reach the files."""
    types = dict(df.dtypes)
    pending = [c for c in columns if c in types and types[c] != "double"]
    return df.withColumns({c: parsing.number(F.col(c)) for c in pending}) if pending else df


def prepare(df: DataFrame) -> DataFrame:
    """Everything the model needs short of the fitted stages."""
    return cast_numeric(add_time_features(df))


def valid_rows(df: DataFrame, columns: Sequence[str] = NUMERIC_FEATURES) -> DataFrame:
    """Rows the vector assembler keeps: no number missing or NaN."""
    types = dict(df.dtypes)
    keep = F.lit(True)
    for c in columns:
        keep = keep & F.col(c).isNotNull()
        if types[c] in ("double", "float"):
            keep = keep & ~F.isnan(c)
    return df.where(keep)


def delayed_flights(df: DataFrame, label: str = "is_delayed") -> DataFrame:
    return df.where(F.col(label) == 1)


def delay_status(prediction: Column) -> Column:
    """Readable verdict; a missing prediction counts as on time."""
    return F.when(prediction == 1.0, "DELAYED").otherwise("ON TIME")


def first_rows(df: DataFrame, n: int, *order: str) -> DataFrame:
    """The first ``n`` rows in a stated order (a top-k, not a full sort)."""
    return df.orderBy(*order).limit(n)
