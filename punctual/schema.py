"""The flight record: column names, types and the roles columns play.

One explicit schema serves batch and stream. CSV type inference is never
used: it would read ``06:15`` as a timestamp of today.
"""

from __future__ import annotations

from pyspark.sql.types import DoubleType, StringType, StructField, StructType

# The 18 columns of a flight record, in file order, and the
# columns among them that hold numbers.
COLUMNS = (
    "flight_id",
    "date",
    "carrier",
    "flight_number",
    "origin",
    "destination",
    "scheduled_departure",
    "scheduled_arrival",
    "distance_miles",
    "weather_origin",
    "weather_destination",
    "temperature_origin",
    "wind_speed_origin",
    "taxi_out_minutes",
    "taxi_in_minutes",
    "departure_delay_minutes",
    "arrival_delay_minutes",
    "is_delayed",
)
NUMERIC_COLUMNS = (
    "distance_miles",
    "temperature_origin",
    "wind_speed_origin",
    "taxi_out_minutes",
    "taxi_in_minutes",
    "departure_delay_minutes",
    "arrival_delay_minutes",
    "is_delayed",
)

# Model inputs. Both delay-minute columns stay out, since they
# would give the label away.
CATEGORICAL_FEATURES = (
    "carrier",
    "origin",
    "destination",
    "weather_origin",
    "weather_destination",
)
NUMERIC_FEATURES = (
    "scheduled_departure_hour",
    "scheduled_departure_minute",
    "day_of_week",
    "month",
    "distance_miles",
    "temperature_origin",
    "wind_speed_origin",
    "taxi_out_minutes",
    "taxi_in_minutes",
)
LABEL = "is_delayed"

# Columns of a scored row.
SCORED_COLUMNS = (
    "flight_id",
    "carrier",
    "origin",
    "destination",
    "scheduled_departure",
    "weather_origin",
    "prediction",
    "delay_status",
)


def typed_schema(names=COLUMNS) -> StructType:
    """Flight columns with their types; unknown names are read as text."""
    return StructType(
        [StructField(n, DoubleType() if n in NUMERIC_COLUMNS else StringType()) for n in names]
    )


def text_schema(names=COLUMNS) -> StructType:
    """The same columns, every one of them text, as they travel in the feed."""
    return StructType([StructField(n, StringType()) for n in names])
