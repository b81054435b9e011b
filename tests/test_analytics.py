import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from punctual.operators import analytics
from punctual.plans.flights import flights_table
from punctual.schema import NUMERIC_COLUMNS

NAN = float("nan")


@pytest.fixture(scope="module")
def labelled(spark):
    return spark.createDataFrame(
        [("a", 1.0), ("a", 0.0), ("a", None), ("b", 1.0), ("b", NAN), (None, 1.0), ("c", None)],
        "k string, is_delayed double",
    )


def test_summary_ignores_missing_labels(labelled):
    row = analytics.dataset_summary(labelled).first()
    assert (row.total, row.delayed, row.not_delayed, row.percent_delayed) == (7, 3, 1, 75.0)


def test_summary_of_one_class_and_of_nothing(labelled):
    only = analytics.dataset_summary(labelled.where("is_delayed = 1")).first()
    assert only.percent_delayed == 100.0
    assert analytics.dataset_summary(labelled.limit(0)).first().percent_delayed is None


def test_rates_skip_missing_keys_and_labels(labelled):
    rates = [tuple(r) for r in analytics.rate_by(labelled, "k").collect()]
    assert rates == [("b", 1.0), ("a", 0.5), ("c", None)]
    assert analytics.overall_rate(labelled).first()[0] == 0.75


def test_equal_rates_rank_by_key(spark):
    rows = spark.createDataFrame([("b", 1.0), ("a", 1.0), ("c", 0.0)], "k string, is_delayed double")
    assert [r.k for r in analytics.rate_by(rows, "k").collect()] == ["a", "b", "c"]


def test_shares(labelled):
    shares = [tuple(r) for r in analytics.value_shares(labelled, "k").collect()]
    assert shares == [("a", 3, 0.5), ("b", 2, 2 / 6), ("c", 1, 1 / 6)]


def test_distinct_counts_leave_out_null(labelled):
    assert analytics.distinct_counts(labelled, ["k"]).first().n_k == 3


def test_top_origins(spark):
    origins = (("A", 3, 1), ("B", 2, 2), ("C", 4, 2), ("D", 3, 1))  # name, flights, delayed
    data = [(f"f{i}", o, float(i < d)) for o, n, d in origins for i in range(n)]
    rows = spark.createDataFrame(data, "flight_id string, origin string, is_delayed double")
    best = analytics.top_origins(rows, min_flights=3, n=2)
    assert [(r.origin, r.total_flights) for r in best.collect()] == [("C", 4), ("A", 3)]


def _as_frame(result, columns):
    table = result.toPandas().pivot(index="feature_a", columns="feature_b", values="correlation")
    return table.loc[list(columns), list(columns)].astype(float)


def test_correlation_with_gaps_equals_data_frame(spark):
    rng = np.random.default_rng(7)
    data = pd.DataFrame(rng.normal(size=(500, 4)) + [0, 5, 1e7, -3], columns=list("abcd"))
    data["b"] += data["a"]
    data["d"] = 4.0
    for i, c in enumerate("abc"):
        data.loc[rng.random(500) < 0.1 * (i + 1), c] = np.nan
    found = _as_frame(analytics.correlation_matrix(spark.createDataFrame(data), list("abcd")), "abcd")
    # the data frame's own value is off in the ninth digit for the mean of 1e7
    pd.testing.assert_frame_equal(found, data.corr(), check_names=False, atol=1e-8, rtol=0)
    assert found["d"].isna().all()


@pytest.mark.parametrize("first", ["missing", "far"])
def test_correlation_does_not_depend_on_first_rows(spark, first):
    """Around 1e9, the first rows unknown or far off: still the plain value."""
    rng = np.random.default_rng(3)
    a = 1e9 + rng.normal(size=20_000)
    data = pd.DataFrame({"a": a, "b": a + rng.normal(size=20_000)})
    if first == "missing":
        data.loc[:999, ["a", "b"]] = np.nan
    else:
        data.loc[0] = [0.0, np.nan]
    known = data.dropna()
    true = np.corrcoef(known.a - 1e9, known.b - 1e9)[0, 1]
    for rows in (data, data.sample(frac=1, random_state=1)):
        found = _as_frame(analytics.correlation_matrix(spark.createDataFrame(rows), ["a", "b"]), "ab")
        assert found.loc["a", "b"] == pytest.approx(true, abs=1e-6)


def test_correlation_constant_only_where_both_known(spark):
    data = pd.DataFrame({"a": [1.0, 1.0, 2.0, 3.0], "b": [5.0, 6.0, np.nan, np.nan]})
    found = _as_frame(analytics.correlation_matrix(spark.createDataFrame(data), ["a", "b"]), "ab")
    assert math.isnan(found.loc["a", "b"]) and found.loc["a", "a"] == 1.0


def test_correlation_without_rows_lists_every_pair(spark):
    empty = spark.createDataFrame([], "a double, b double")
    found = analytics.correlation_matrix(empty, ["a", "b"]).collect()
    assert len(found) == 4 and all(r.correlation is None for r in found)


def _check_histogram(spark, values, bins=50):
    rows = spark.createDataFrame(pd.DataFrame({"v": np.asarray(values, dtype=float)}))
    found = analytics.histogram(rows, "v", bins).collect()
    kept = np.asarray([v for v in values if not math.isnan(v)], dtype=float)
    counts, edges = np.histogram(kept, bins=bins)
    assert [r.n for r in found] == counts.tolist()
    assert [r.left_edge for r in found] == edges[:-1].tolist()
    assert [r.right_edge for r in found] == edges[1:].tolist()


@pytest.mark.parametrize("seed", range(3))
def test_histogram_of_whole_minutes(spark, seed):
    rng = np.random.default_rng(seed)
    _check_histogram(spark, rng.integers(seed, 340 + 7 * seed, 3000).astype(float))


def test_histogram_of_values_on_edges(spark):
    edges = np.linspace(0.1, 7.7, 51)
    _check_histogram(spark, np.concatenate([edges, np.nextafter(edges[1:], 0)]))


def test_histogram_single_value_gaps_and_nothing(spark):
    _check_histogram(spark, [3.0, 3.0])
    _check_histogram(spark, [1.0, NAN, 2.0], bins=4)
    empty = analytics.histogram(spark.createDataFrame([], "v double"), "v", 5).collect()
    assert [(r.left_edge, r.n) for r in empty] == [(e, 0) for e in np.histogram([], bins=5)[1][:-1]]


def test_histogram_of_delays(spark, medium):
    delayed = flights_table(spark, medium).where("is_delayed = 1")
    for c in ("departure_delay_minutes", "arrival_delay_minutes"):
        values = delayed.select(c).toPandas()[c].to_numpy()
        found = analytics.histogram(delayed, c).collect()
        assert [r.n for r in found] == np.histogram(values, bins=50)[0].tolist()


def test_correlation_of_flights(spark, medium):
    flights = flights_table(spark, medium)
    found = _as_frame(analytics.correlation_matrix(flights), NUMERIC_COLUMNS)
    expected = flights.select(*NUMERIC_COLUMNS).toPandas().corr()
    pd.testing.assert_frame_equal(found, expected, check_names=False, atol=1e-9, rtol=0)


def test_uplift_defaults_to_the_complement(spark):
    rows = spark.createDataFrame([(1, 1.0), (1, 0.0), (2, 0.0)], "g int, is_delayed double")
    row = analytics.rate_uplift(rows, F.col("g") == 1).first()
    assert tuple(row) == (0.5, 0.0, 0.5)
