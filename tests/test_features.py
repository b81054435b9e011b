from datetime import date

import pytest
from pyspark.sql import functions as F

from punctual.operators import features


def _times(spark, day, clock):
    row = spark.createDataFrame([(day, clock)], "date string, scheduled_departure string")
    return features.add_time_features(row).first()


@pytest.mark.parametrize(
    "clock, hour, minute",
    [("06:15", 6, 15), ("0615", 615, None), ("ab:cd", None, None), (None, None, None), ("23:45", 23, 45)],
)
def test_clock(spark, clock, hour, minute):
    row = _times(spark, "2022-01-02", clock)
    assert (row.scheduled_departure_hour, row.scheduled_departure_minute) == (hour, minute)


@pytest.mark.parametrize(
    "text, parsed, weekday, month",
    [
        ("2022-01-02", date(2022, 1, 2), 1, 1),
        ("2022-12-31", date(2022, 12, 31), 7, 12),
        ("x", None, None, None),
        (None, None, None, None),
    ],
)
def test_date(spark, text, parsed, weekday, month):
    row = _times(spark, text, "06:15")
    assert (row.date, row.day_of_week, row.month) == (parsed, weekday, month)


def test_typed_date_is_kept(spark):
    typed = spark.sql("SELECT DATE '2022-01-02' AS date, '06:15' AS scheduled_departure")
    assert features.add_time_features(typed).first().day_of_week == 1


def test_cast_skips_absent_and_typed_columns(spark):
    rows = spark.createDataFrame([("12", 1.5, "x")], "distance_miles string, is_delayed double, other string")
    cast = features.cast_numeric(rows)
    assert cast.dtypes == [("distance_miles", "double"), ("is_delayed", "double"), ("other", "string")]
    assert cast.first().distance_miles == 12.0


def test_unreadable_number_is_null(spark):
    rows = spark.createDataFrame([("12a",), ("",), (None,), (" 7 ",)], "distance_miles string")
    values = [r[0] for r in features.cast_numeric(rows).collect()]
    assert values == [None, None, None, 7.0]


def test_valid_rows_drop_null_and_nan(spark):
    rows = spark.createDataFrame(
        [(1.0, 1), (None, 2), (float("nan"), 3), (2.0, None)], "a double, b int"
    )
    assert [tuple(r) for r in features.valid_rows(rows, ["a", "b"]).collect()] == [(1.0, 1)]


def test_delay_status(spark):
    rows = spark.createDataFrame([(1.0,), (0.0,), (None,)], "p double")
    status = [r[0] for r in rows.select(features.delay_status(F.col("p"))).collect()]
    assert status == ["DELAYED", "ON TIME", "ON TIME"]
