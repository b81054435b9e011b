"""Column expressions for reading text fields; bad text becomes NULL, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def flight_date(text: Column) -> Column:
    """Calendar date written ``yyyy-MM-dd``."""
    return F.try_to_date(text, "yyyy-MM-dd")


def clock_part(text: Column, position: int) -> Column:
    """Hour (0) or minute (1) of a clock time written ``HH:MM``."""
    return F.get(F.split(text, ":"), F.lit(position)).try_cast("int")


def number(text: Column) -> Column:
    """Double from text or any numeric type."""
    return text.try_cast("double")


def padded(value: Column, width: int) -> Column:
    """A whole number as text, zero-padded to ``width``; longer ones keep all digits."""
    text = value.cast("string")
    return F.lpad(text, F.greatest(F.lit(width), F.length(text)), "0")


def present(value: Column) -> Column:
    """A double with NaN read as missing, as data frames in Python do."""
    return F.nanvl(value, F.lit(None).cast("double"))
