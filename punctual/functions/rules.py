"""Domain rules of the flight data as pure column expressions.

Probabilities are integers in thousandths, so that every engine computes the
same value.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Weather kinds with their weight in percent.
WEATHER_WEIGHTS = (
    ("Clear", 40),
    ("Cloudy", 25),
    ("Rain", 15),
    ("Snow", 8),
    ("Fog", 7),
    ("Thunderstorm", 5),
)

# Delay probability in thousandths.
BASE_MILLI = 120
STORM_MILLI = 250
FROST_MILLI = 200
PEAK_MILLI = 80
HUB_MILLI = 50
MOST_MILLI = 750
STORM_WEATHER = ("Rain", "Thunderstorm")
FROST_WEATHER = ("Snow", "Fog")
CALM_WEATHER = ("Clear", "Cloudy")
PEAK_HOURS = ((6, 9), (16, 20))

# Delay length in minutes (first, last) with the upper bound, in
# thousandths, of the draw that selects it.
DELAY_TIERS = ((500, 15, 45), (800, 46, 120), (1000, 121, 360))

# Fixed value: minutes from which a departure counts as delayed.
DELAYED_FROM = 15


def weighted_choice(percent: Column, choices: Sequence[tuple[str, int]]) -> Column:
    """The choice whose cumulative weight first exceeds ``percent`` (0..99)."""
    picked, reached = None, 0
    for value, weight in choices[:-1]:
        reached += weight
        hit = percent < reached
        picked = F.when(hit, value) if picked is None else picked.when(hit, value)
    return picked.otherwise(choices[-1][0])


def weather(percent: Column) -> Column:
    return weighted_choice(percent, WEATHER_WEIGHTS)


def other_than(own: Column, draw: Column, size: int) -> Column:
    """An index below ``size`` that never equals ``own``, uniform in ``draw``."""
    return (own + 1 + draw % (size - 1)) % size


def is_peak(hour: Column) -> Column:
    """Morning or evening rush, both ends included."""
    (morning, noon), (evening, night) = PEAK_HOURS
    return hour.between(morning, noon) | hour.between(evening, night)


def delay_probability_milli(weather_at_origin: Column, hour: Column, is_hub: Column) -> Column:
    """Chance of a delayed departure, in thousandths."""
    by_weather = (
        F.when(weather_at_origin.isin(*STORM_WEATHER), STORM_MILLI)
        .when(weather_at_origin.isin(*FROST_WEATHER), FROST_MILLI)
        .otherwise(0)
    )
    by_hour = F.when(is_peak(hour), PEAK_MILLI).otherwise(0)
    by_hub = F.when(is_hub, HUB_MILLI).otherwise(0)
    return F.least(F.lit(BASE_MILLI) + by_weather + by_hour + by_hub, F.lit(MOST_MILLI))


def delay_minutes(probability: Column, occurs: Column, tier: Column, pick: Column) -> Column:
    """Minutes of delay from three draws: ``occurs`` and ``tier`` below 1000,
    ``pick`` any non-negative integer that places the delay inside its tier."""
    length = F.when(occurs >= probability, 0)
    for bound, first, last in DELAY_TIERS:
        length = length.when(tier < bound, first + pick % (last - first + 1))
    return length


def arrival_delay(departure_delay: Column, jitter: Column) -> Column:
    """Delay on arrival; early arrivals count as zero."""
    return F.greatest(F.lit(0), departure_delay + jitter)


def delayed_label(minutes: Column) -> Column:
    """1.0 for a delayed departure, else 0.0."""
    return (minutes >= DELAYED_FROM).cast("double")


def _two_digits(value: Column) -> Column:
    return F.lpad(value.cast("string"), 2, "0")


def clock(hour: Column, minute: Column) -> Column:
    """``HH:MM`` text."""
    return F.concat(_two_digits(hour), F.lit(":"), _two_digits(minute))


def clock_after(hour: Column, minute: Column, minutes: Column) -> Column:
    """The clock ``minutes`` later, past midnight starting again at 00:00."""
    moment = (hour * 60 + minute + minutes) % 1440
    return clock(F.floor(moment / 60), moment % 60)
