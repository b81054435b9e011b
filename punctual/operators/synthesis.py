"""Flights made up by rule from any key column, one per row, fully parallel."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date
from string import ascii_uppercase

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from punctual.functions import draws, rules
from punctual.functions.parsing import padded
from punctual.schema import COLUMNS

# Carriers and hub airports.
CARRIERS = (
    "AA", "DL", "UA", "WN", "B6", "AS", "NK", "F9", "G4", "HA",
    "SY", "QX", "YX", "OH", "MQ", "OO", "9E", "YV",
)
HUBS = (
    "ATL", "LAX", "ORD", "DFW", "DEN", "JFK", "SFO", "SEA", "LAS", "MCO",
    "EWR", "CLT", "PHX", "IAH", "MIA", "BOS", "MSP", "FLL", "DTW", "PHL",
)

# Fixed value: airports in all.
N_AIRPORTS = 205


def airport_codes(n: int = N_AIRPORTS, hubs: Sequence[str] = HUBS) -> tuple[str, ...]:
    """The hubs followed by invented codes XAA, XAB, ... up to ``n`` codes."""
    letters = [f"X{a}{b}" for a in ascii_uppercase for b in ascii_uppercase]
    others = [code for code in letters if code not in hubs]
    if n > len(hubs) + len(others):
        raise ValueError(f"at most {len(hubs) + len(others)} airport codes")
    return (*hubs, *others)[:n]


def _pick(values: Sequence[str], index: Column) -> Column:
    return F.get(F.array(*[F.lit(v) for v in values]), index.cast("int"))


def _floor_at(least: int, value: Column) -> Column:
    return F.greatest(F.lit(least), value)


def synthesise(
    keys: DataFrame,
    key: str,
    seed: int = 42,
    first_day: date = date(2022, 1, 1),
    last_day: date = date(2022, 12, 31),
    airports: Sequence[str] | None = None,
    hubs: Sequence[str] = HUBS,
    uniform: Callable[[Column, int], draws.Draw] = draws.fast_uniform,
) -> DataFrame:
    """One flight for each row of ``keys``; ``key`` is a unique whole number."""
    airports = tuple(airports or airport_codes(hubs=hubs))
    u = uniform(F.col(key), seed)
    n = len(airports)
    raw = keys.select(
        F.col(key).alias("key"),
        draws.below(u(0), (last_day - first_day).days + 1).cast("int").alias("day"),
        _pick(CARRIERS, draws.below(u(1), len(CARRIERS))).alias("carrier"),
        draws.below(u(2), n).alias("from_index"),
        draws.below(u(3), n - 1).alias("to_draw"),
        draws.within(u(4), 5, 23).alias("hour"),
        (draws.below(u(5), 4) * 15).alias("minute"),
        draws.within(u(6), 60, 420).alias("duration"),
        rules.weather(draws.below(u(7), 100)).alias("weather_origin"),
        rules.weather(draws.below(u(8), 100)).alias("weather_destination"),
        F.bround(draws.normal(u(9), u(10), 60, 20), 1).alias("temperature_origin"),
        F.bround(draws.normal(u(11), u(12), 10, 7), 1).alias("wind"),
        draws.within(u(13), 100, 4000).cast("double").alias("distance_miles"),
        draws.normal(u(14), u(15), 18, 8).cast("int").alias("taxi_out"),
        draws.normal(u(16), u(17), 12, 5).cast("int").alias("taxi_in"),
        draws.below(u(18), 1000).alias("occurs"),
        draws.below(u(19), 1000).alias("tier"),
        # divisible by the length of every delay tier, so each is uniform
        draws.below(u(20), 31 * 75 * 240).alias("pick"),
        draws.within(u(21), -10, 15).alias("jitter"),
        draws.within(u(22), 100, 9999).alias("number"),
    )
    placed = raw.withColumns(
        {
            "origin": _pick(airports, F.col("from_index")),
            "destination": _pick(
                airports, rules.other_than(F.col("from_index"), F.col("to_draw"), n)
            ),
        }
    )
    delayed = placed.withColumn(
        "delay",
        rules.delay_minutes(
            rules.delay_probability_milli(
                F.col("weather_origin"), F.col("hour"), F.col("origin").isin(*hubs)
            ),
            F.col("occurs"),
            F.col("tier"),
            F.col("pick"),
        ),
    )
    made = {
        "flight_id": F.concat(F.lit("FL"), padded(F.col("key"), 7)),
        "date": F.date_format(F.date_add(F.lit(first_day), F.col("day")), "yyyy-MM-dd"),
        "flight_number": F.concat("carrier", F.col("number").cast("string")),
        "scheduled_departure": rules.clock(F.col("hour"), F.col("minute")),
        "scheduled_arrival": rules.clock_after(
            F.col("hour"), F.col("minute"), F.col("duration")
        ),
        "wind_speed_origin": F.greatest(F.lit(0.0), F.col("wind")),
        "taxi_out_minutes": _floor_at(5, F.col("taxi_out")).cast("double"),
        "taxi_in_minutes": _floor_at(3, F.col("taxi_in")).cast("double"),
        "departure_delay_minutes": F.col("delay").cast("double"),
        "arrival_delay_minutes": rules.arrival_delay(F.col("delay"), F.col("jitter")).cast(
            "double"
        ),
        "is_delayed": rules.delayed_label(F.col("delay")),
    }
    return delayed.select(*[made[c].alias(c) if c in made else F.col(c) for c in COLUMNS])


def synthetic_flights(spark: SparkSession, n: int, seed: int = 42, **options) -> DataFrame:
    """``n`` flights keyed 0 .. n - 1."""
    return synthesise(spark.range(n), "id", seed, **options)
