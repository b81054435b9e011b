from itertools import product

import pytest
from pyspark.sql import functions as F

from punctual.functions import draws, rules
from punctual.operators import synthesis

KINDS = [k for k, _ in rules.WEATHER_WEIGHTS]


def test_delay_probability_of_every_case(spark):
    cases = spark.createDataFrame(
        list(product(KINDS, range(24), [True, False])), "weather string, hour int, hub boolean"
    )
    milli = rules.delay_probability_milli(F.col("weather"), F.col("hour"), F.col("hub"))
    extra = {"Rain": 250, "Thunderstorm": 250, "Snow": 200, "Fog": 200}
    for r in cases.withColumn("p", milli).collect():
        peak = r.hour in (6, 7, 8, 9, 16, 17, 18, 19, 20)
        assert r.p == min(750, 120 + extra.get(r.weather, 0) + 80 * peak + 50 * r.hub)


def test_weights_cover_every_percent(spark):
    counts = spark.range(100).groupBy(rules.weather(F.col("id")).alias("w")).count().collect()
    assert {r.w: r["count"] for r in counts} == dict(rules.WEATHER_WEIGHTS)


def test_other_than_is_uniform_and_never_own(spark):
    pairs = spark.range(5).withColumnRenamed("id", "own").crossJoin(spark.range(4))
    got = pairs.select("own", rules.other_than(F.col("own"), F.col("id"), 5).alias("to")).collect()
    for own in range(5):
        assert sorted(r.to for r in got if r.own == own) == [i for i in range(5) if i != own]


@pytest.mark.parametrize(
    "occurs, tier, pick, minutes",
    [(300, 0, 0, 0), (299, 499, 30, 45), (0, 0, 31, 15), (0, 500, 74, 120), (0, 800, 239, 360), (0, 999, 0, 121)],
)
def test_delay_minutes(spark, occurs, tier, pick, minutes):
    args = [F.lit(v) for v in (300, occurs, tier, pick)]
    assert spark.range(1).select(rules.delay_minutes(*args)).first()[0] == minutes


def test_arrival_and_label(spark):
    rows = spark.createDataFrame([(0, -10), (15, -10), (14, 15)], "d int, j int")
    got = rows.select(rules.arrival_delay(F.col("d"), F.col("j")), rules.delayed_label(F.col("d")))
    assert [tuple(r) for r in got.collect()] == [(0, 0.0), (5, 1.0), (29, 0.0)]


@pytest.mark.parametrize("start, added, end", [((23, 45), 60, "00:45"), ((5, 0), 420, "12:00"), ((0, 0), 0, "00:00")])
def test_clock_wraps_at_midnight(spark, start, added, end):
    clock = rules.clock_after(F.lit(start[0]), F.lit(start[1]), F.lit(added))
    assert spark.range(1).select(clock).first()[0] == end


@pytest.mark.parametrize("kind", [draws.fast_uniform, draws.portable_uniform])
def test_draws_are_uniform_and_repeatable(spark, kind):
    u = kind(F.col("id"), 42)
    rows = spark.range(20000).select("id", u(0).alias("a"), u(5).alias("b"))
    row = rows.agg(F.min("a"), F.max("a"), F.avg("a"), F.corr("a", "b")).first()
    assert 0 <= row[0] and row[1] < 1
    assert abs(row[2] - 0.5) < 0.01 and abs(row[3]) < 0.03
    again = spark.range(20000).repartition(3).select("id", u(0).alias("a"))
    assert rows.select("id", "a").exceptAll(again).isEmpty()


def test_normal_draws(spark):
    u = draws.fast_uniform(F.col("id"), 1)
    x = draws.normal(u(0), u(1), 60, 20)
    mean, spread = spark.range(50000).agg(F.avg(x), F.stddev(x)).first()
    assert abs(mean - 60) < 0.5 and abs(spread - 20) < 0.4


@pytest.fixture(scope="module")
def made(spark):
    return synthesis.synthetic_flights(spark, 60000).cache()


def test_synthetic_flights_keep_their_domains(made):
    wrong = made.where(
        "origin = destination OR date NOT BETWEEN '2022-01-01' AND '2022-12-31'"
        " OR distance_miles NOT BETWEEN 100 AND 4000 OR taxi_out_minutes < 5 OR taxi_in_minutes < 3"
        " OR wind_speed_origin < 0 OR departure_delay_minutes BETWEEN 1 AND 14"
        " OR departure_delay_minutes > 360 OR arrival_delay_minutes < 0"
        " OR is_delayed <> CAST(departure_delay_minutes >= 15 AS DOUBLE)"
        " OR scheduled_departure NOT RLIKE '^(0[5-9]|1[0-9]|2[0-3]):(00|15|30|45)$'"
        " OR scheduled_arrival NOT RLIKE '^([01][0-9]|2[0-3]):(00|15|30|45|[0-5][0-9])$'"
    )
    assert wrong.isEmpty()
    counts = made.agg(
        *[F.count_distinct(c) for c in ("flight_id", "origin", "destination", "carrier", "date")]
    ).first()
    assert tuple(counts) == (60000, 205, 205, 18, 365)


def test_delay_rate_of_every_cell_follows_the_rule(made):
    hour = F.substring("scheduled_departure", 1, 2).cast("int")
    milli = rules.delay_probability_milli(
        F.col("weather_origin"), hour, F.col("origin").isin(*synthesis.HUBS)
    )
    cells = made.groupBy(milli.alias("p")).agg(F.count("*").alias("n"), F.avg("is_delayed").alias("r"))
    for c in cells.collect():
        p = c.p / 1000
        assert abs(c.r - p) <= 4 * (p * (1 - p) / c.n) ** 0.5, c


def test_synthesis_does_not_depend_on_partitioning(spark):
    a = synthesis.synthetic_flights(spark, 500)
    b = synthesis.synthesise(spark.range(500).repartition(7), "id")
    assert a.exceptAll(b).isEmpty()
    assert not synthesis.synthetic_flights(spark, 500, seed=7).exceptAll(a).isEmpty()


def test_airport_codes():
    codes = synthesis.airport_codes()
    assert len(set(codes)) == 205 and set(synthesis.HUBS) <= set(codes)
    with pytest.raises(ValueError):
        synthesis.airport_codes(10000)
