"""The plans are the ones wanted: pruned scans, no Python, no cross joins, skew split."""

import pytest
from pyspark.sql import functions as F

from punctual.operators import analytics, features
from punctual.plans import flights
from punctual.plans import queries as registered
from punctual.plans.flights import flights_from_lines, flights_table, read_table
from punctual.plans.queries import queries

TRAINED = {"gbt_train", "gbt_predict", "model_roundtrip"}


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_filter_and_columns_reach_the_files(spark, small):
    delayed = features.delayed_flights(flights_table(spark, small)).select("flight_id")
    plan = _plan(delayed)
    assert "PushedFilters: [IsNotNull(is_delayed), EqualTo(is_delayed,1.0)]" in plan
    assert "ReadSchema: struct<flight_id:string,is_delayed:double>" in plan


def test_filter_reaches_the_files_through_preparation(spark, small):
    flights = features.prepare(flights_table(spark, small)).where("is_delayed = 1")
    assert "EqualTo(is_delayed,1.0)" in _plan(flights)


def test_top_k_does_not_sort_everything(spark, small):
    plan = _plan(analytics.top_origins(flights_table(spark, small)))
    assert "TakeOrderedAndProject" in plan
    assert "ReadSchema: struct<flight_id:string,origin:string,is_delayed:double>" in plan


@pytest.mark.parametrize("name", ["dataset_summary", "rate_by_carrier", "origin_stats", "uplift_hub"])
def test_reports_shuffle_partial_results_only(spark, small, name):
    plan = _plan(queries()[name](spark, small))
    assert "functions=[partial_" in plan and plan.count("FileScan") == 1


@pytest.mark.parametrize("name", sorted(set(queries()) - TRAINED))
def test_no_python_and_no_cross_joins(spark, small, name):
    plan = _plan(queries()[name](spark, small))
    for node in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in plan


def test_hot_part_is_split(spark, small):
    """A part with a third of all lines, beyond the broadcast limit: the join
    splits its partition and loses no row."""
    lines = read_table(spark, small, "lineitem")
    lines = lines.unionAll(lines).withColumn(
        "l_partkey", F.when(F.col("l_orderkey") % 3 == 0, 7).otherwise(F.col("l_partkey"))
    )
    part = read_table(spark, small, "part")
    expected = flights_from_lines(lines, F.broadcast(part)).agg(F.count("*"), F.sum("is_delayed")).first()
    limits = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1000",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    for key, value in limits.items():
        spark.conf.set(key, value)
    try:
        flights = flights_from_lines(lines.repartition(16), part).select("flight_id", "is_delayed")
        joined = flights.agg(F.count("*"), F.sum("is_delayed"))
        assert joined.collect()[0] == expected
        assert "skew=true" in _plan(joined)
    finally:
        for key in limits:
            spark.conf.unset(key)


def test_flights_move_as_narrow_lines(spark, small):
    """Shuffles of the derivation carry the line's columns, not its draws or the flight's."""
    lines, part = read_table(spark, small, "lineitem"), read_table(spark, small, "part")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = flights_from_lines(lines, part)._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    below = plan[plan.index("Join Inner") :]
    assert "h1" not in below and "prob_milli" not in below and "weather" not in below


def test_flight_table_is_dealt_by_hash_before_flights_are_made(spark, small, monkeypatch):
    """No sort of wide rows before the shuffle, as dealing out in turn would need."""
    inputs, make = [], flights._flights
    monkeypatch.setattr(flights, "_flights", lambda lines: inputs.append(lines) or make(lines))
    monkeypatch.setattr(flights, "_WRITTEN", {})
    flights.flights_table(spark, small)
    (lines,) = inputs
    assert set(lines.columns) == {*flights._LINE_COLUMNS, "p_brand"}
    plan = lines._jdf.queryExecution().optimizedPlan().toString()
    assert plan.startswith("RebalancePartitions [l_orderkey")


def test_damaged_messages_are_parsed_once(spark, small):
    plan = registered._damaged(spark, small)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("get_json_object") == 1


def test_ids_of_a_split_lie_in_parts_of_bounded_size(spark, small, monkeypatch):
    """Not merged by their compressed bytes; the whole table is still there once."""
    monkeypatch.setattr(registered, "_IDS_PER_PART", 100)
    n = flights_table(spark, small).select("flight_id").distinct().count()
    ids = registered._ids(spark, small)
    sizes = ids.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n"))
    assert ids.count() == ids.distinct().count() == n
    assert sizes.agg(F.max("n")).first()[0] < 200
    facts = registered._split_facts(registered.learning.random_split(ids)).first()
    assert (facts.n, facts.n_on_both, facts.share_holds) == (n, 0, True)
