"""The registered queries: every operator over the whole of the given tables."""

from __future__ import annotations

import time
from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.errors import StreamingQueryException
from pyspark.ml.feature import VectorSlicer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from punctual.functions import parsing, rules
from punctual.operators import analytics, dictionary, features, learning, metrics
from punctual.plans.flights import (
    flights_table,
    flights_view,
    read_table,
    with_delay,
    with_draws,
)
from punctual.schema import (
    CATEGORICAL_FEATURES,
    COLUMNS,
    NUMERIC_COLUMNS,
    NUMERIC_FEATURES,
    SCORED_COLUMNS,
    text_schema,
)
from punctual.session import scratch_folder
from punctual.settings import Settings
from punctual.sources import feed, files
from punctual.streaming import monitor, scoring

Query = Callable[[SparkSession, str], DataFrame]

# The library's trees and depth; how many are kept is decided on held-out rows.
CHECK_SETTINGS = Settings(encoding="binned", validation_percent=10)

_QUERIES: dict[str, Query] = {}


def _query(build: Query) -> Query:
    _QUERIES[build.__name__] = build
    return build


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


# ---- the flight table, sources and sinks -----------------------------------------


_query(flights_view)


@_query
def scan_csv(spark, sf_dir):
    path = scratch_folder(spark, "csv")
    files.write_flights_csv(flights_table(spark, sf_dir), path)
    return files.read_flights_csv(spark, path)


@_query
def table_shape(spark, sf_dir):
    return analytics.table_shape(flights_table(spark, sf_dir))


@_query
def table_head(spark, sf_dir):
    ordered = ("flight_id", "date", "scheduled_departure", "distance_miles")
    return features.first_rows(flights_table(spark, sf_dir), 5, *ordered)


@_query
def feed_rows(spark, sf_dir):
    """CSV to keyed JSON, values read back as text."""
    path = scratch_folder(spark, "feed-csv")
    files.write_flights_csv(flights_table(spark, sf_dir), path)
    records = feed.keyed_records(files.read_feed_csv(spark, path), max_records=0)
    data = F.from_json("value", text_schema())
    return records.select("key", data.alias("data")).select("key", "data.*")


@_query
def feed_cap(spark, sf_dir):
    """A capped feed of CSV files: the first rows in the order of the files."""
    path = scratch_folder(spark, "cap-csv")
    # one file per range of the id, so that name order is known
    ranged = flights_table(spark, sf_dir).repartitionByRange("flight_id")
    files.write_flights_csv(ranged.sortWithinPartitions(*COLUMNS), path, compression="gzip")
    capped = feed.keyed_records(files.read_feed_csv(spark, path), max_records=1000)
    return capped.select("key", F.get_json_object("value", "$.flight_id").alias("flight_id"))


@_query
def feed_key(spark, sf_dir):
    """Keys of full records, of records with an empty origin, and without the column."""
    rows = flights_table(spark, sf_dir)
    blanked = rows.withColumn(
        "origin", F.when(F.col("weather_origin") == "Fog", "").otherwise(F.col("origin"))
    )
    return blanked.select(
        "flight_id",
        feed.record_key(blanked).alias("key"),
        feed.record_key(blanked.drop("origin")).alias("key_without_origin"),
    )


# ---- projection, filters, casts -----------------------------------------------------


@_query
def time_features(spark, sf_dir):
    """Calendar and clock features, with unreadable dates and clocks mixed in."""
    rows = flights_table(spark, sf_dir).withColumns(
        {
            "date": F.when(F.col("carrier") == "Brand#13", "x").otherwise(F.col("date")),
            "scheduled_departure": F.when(F.col("weather_origin") == "Fog", "0615")
            .when(F.col("weather_origin") == "Snow", "ab:cd")
            .otherwise(F.col("scheduled_departure")),
        }
    )
    return features.add_time_features(rows).select(
        "flight_id",
        "date",
        "day_of_week",
        "month",
        "scheduled_departure_hour",
        "scheduled_departure_minute",
    )


@_query
def cast_numeric(spark, sf_dir):
    """Numbers that arrive as text, some of it unreadable."""
    rows = flights_table(spark, sf_dir)
    text = rows.select(
        "flight_id",
        *[
            F.when(F.col("carrier") == "Brand#11", "n/a")
            .otherwise(F.col(c).cast("string"))
            .alias(c)
            for c in NUMERIC_COLUMNS
        ],
    )
    return features.cast_numeric(text)


@_query
def delayed_flights(spark, sf_dir):
    return features.delayed_flights(flights_table(spark, sf_dir)).select(
        "flight_id", "departure_delay_minutes", "arrival_delay_minutes"
    )


@_query
def status_label(spark, sf_dir):
    """Verdict on rule predictions, those of foggy flights missing."""
    rows = _rule_scored(spark, sf_dir)
    prediction = F.when(F.col("weather_origin") != "Fog", F.col("prediction"))
    return rows.select("flight_id", features.delay_status(prediction).alias("delay_status"))


@_query
def valid_rows(spark, sf_dir):
    """Rows with all model numbers present, after NULLs and NaNs are mixed in."""
    rows = features.prepare(flights_table(spark, sf_dir)).withColumns(
        {
            "temperature_origin": F.when(
                F.col("weather_origin") != "Fog", F.col("temperature_origin")
            ),
            "wind_speed_origin": F.when(
                F.col("weather_origin") == "Snow", F.lit("NaN").cast("double")
            ).otherwise(F.col("wind_speed_origin")),
        }
    )
    return features.valid_rows(rows).select("flight_id", *NUMERIC_FEATURES)


@_query
def hour_of_event(spark, sf_dir):
    """The clock and JSON operators on the event table."""
    events = read_table(spark, sf_dir, "events")
    clock = F.substring(F.col("ts").cast("string"), 12, 5)
    return events.select(
        "event_id",
        parsing.clock_part(clock, 0).alias("hour"),
        parsing.clock_part(clock, 1).alias("minute"),
        F.from_json("props", "k STRING").getField("k").try_cast("double").alias("k"),
    )


# ---- rules ------------------------------------------------------------------------------


def _lines(spark, sf_dir) -> DataFrame:
    return with_delay(with_draws(read_table(spark, sf_dir, "lineitem")))


_LINE_KEY = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


def _is_hub():
    return F.col("origin").endswith("0")


def _departure_hour():
    return parsing.clock_part(F.col("scheduled_departure"), 0)


@_query
def delay_probability(spark, sf_dir):
    milli = rules.delay_probability_milli(F.col("weather_origin"), _departure_hour(), _is_hub())
    return flights_table(spark, sf_dir).select(
        "flight_id", milli.cast("bigint").alias("prob_milli")
    )


@_query
def delay_minutes(spark, sf_dir):
    return _lines(spark, sf_dir).select(*_LINE_KEY, F.col("delay").alias("delay_minutes"))


@_query
def delay_label(spark, sf_dir):
    return flights_table(spark, sf_dir).select(
        "flight_id", rules.delayed_label(F.col("departure_delay_minutes")).alias("label")
    )


@_query
def arrival_delay(spark, sf_dir):
    return _lines(spark, sf_dir).select(
        *_LINE_KEY, rules.arrival_delay(F.col("delay"), F.col("h6") % 26 - 10).alias("arrival_delay")
    )


@_query
def scheduled_arrival(spark, sf_dir):
    """Arrival clock after a flight time that grows with distance."""
    departure = F.col("scheduled_departure")
    minutes = F.floor(F.col("distance_miles") % 361) + 60
    return flights_table(spark, sf_dir).select(
        "flight_id",
        rules.clock_after(
            parsing.clock_part(departure, 0), parsing.clock_part(departure, 1), minutes
        ).alias("arrival"),
    )


@_query
def date_arith(spark, sf_dir):
    day = parsing.flight_date(F.col("date"))
    ahead = (F.col("distance_miles") % 30).cast("int")
    return flights_table(spark, sf_dir).select(
        "flight_id",
        F.date_add(day, ahead).alias("later"),
        F.datediff(day, F.lit("1995-01-01").cast("date")).alias("days_since"),
        F.date_format(day, "yyyy-MM-dd").alias("date_text"),
    )


@_query
def round_weather(spark, sf_dir):
    """Rounding, flooring at a bound and truncation."""
    return flights_table(spark, sf_dir).select(
        "flight_id",
        F.bround(F.col("temperature_origin") * F.lit(0.937), 1).alias("temperature"),
        F.greatest(F.lit(0.0), F.bround(F.col("wind_speed_origin") * F.lit(1.237) - 5, 1)).alias(
            "wind"
        ),
        F.greatest(F.lit(5), (F.col("taxi_out_minutes") / F.lit(1.7)).cast("int")).alias("taxi_out"),
        F.greatest(F.lit(3), (F.col("taxi_in_minutes") / F.lit(1.7)).cast("int")).alias("taxi_in"),
    )


@_query
def weather_mix(spark, sf_dir):
    """Share of each weather kind drawn by weight."""
    lines = read_table(spark, sf_dir, "lineitem")
    percent = (F.col("l_orderkey") * 7919 + F.col("l_partkey") * 104729) % 100
    drawn = lines.select(rules.weather(percent).alias("weather"))
    return analytics.value_shares(drawn, "weather")


@_query
def route_validity(spark, sf_dir):
    """A destination drawn to differ from the origin, then filtered to prove it."""
    size = 100
    lines = read_table(spark, sf_dir, "lineitem").withColumn("from_index", F.col("l_suppkey") % size)
    routes = lines.withColumn(
        "to_index", rules.other_than(F.col("from_index"), F.col("l_partkey"), size)
    )
    return routes.where(F.col("from_index") != F.col("to_index")).select(
        *_LINE_KEY, "from_index", "to_index"
    )


# ---- reports -------------------------------------------------------------------------------


@_query
def dataset_summary(spark, sf_dir):
    return analytics.dataset_summary(flights_table(spark, sf_dir))


@_query
def label_distribution(spark, sf_dir):
    return analytics.value_shares(flights_table(spark, sf_dir), "is_delayed")


@_query
def distinct_counts(spark, sf_dir):
    return analytics.distinct_counts(flights_table(spark, sf_dir), ["origin", "carrier"])


@_query
def distinct_by_month(spark, sf_dir):
    """Distinct airports and carriers per month, and over all months from the
    months' bitmaps alone."""
    columns = ["origin", "destination", "carrier"]
    rows = flights_table(spark, sf_dir).withColumn("month", F.substring("date", 1, 7))
    entries = dictionary.dictionary(rows, columns)
    path = scratch_folder(spark, "bitmaps")
    dictionary.distinct_bitmaps(rows, entries, columns, ["month"]).write.parquet(path)
    bitmaps = spark.read.parquet(path)
    whole = dictionary.merged_distinct(bitmaps).select(F.lit("all").alias("month"), "category", "n")
    return dictionary.merged_distinct(bitmaps, ["month"]).unionAll(whole)


@_query
def training_summary(spark, sf_dir):
    """What a fit would see, with labels and numbers missing here and there."""
    rows = _prepared(spark, sf_dir).withColumns(
        {
            "is_delayed": F.when(F.col("weather_origin") != "Snow", F.col("is_delayed")),
            "temperature_origin": F.when(
                F.col("weather_destination") != "Fog", F.col("temperature_origin")
            ),
        }
    )
    found = learning.training_summary(rows)
    sides = (F.col("train_rows") + F.col("test_rows")).alias("both_sides")
    names = ("total", "delayed", "not_delayed", "percent_delayed", "unlabelled", "skipped")
    return found.select(*names, sides)


@_query
def overall_rate(spark, sf_dir):
    return analytics.overall_rate(flights_table(spark, sf_dir))


@_query
def rate_by_carrier(spark, sf_dir):
    return analytics.rate_by(flights_table(spark, sf_dir), "carrier")


@_query
def rate_by_hour(spark, sf_dir):
    return analytics.rate_by_hour(flights_table(spark, sf_dir))


@_query
def rate_by_weather(spark, sf_dir):
    return analytics.rate_by(flights_table(spark, sf_dir), "weather_origin")


@_query
def rate_by_priority(spark, sf_dir):
    """The rate report on another table: share of finished orders by priority."""
    orders = read_table(spark, sf_dir, "orders").select(
        "o_orderpriority", (F.col("o_orderstatus") == "F").cast("double").alias("finished")
    )
    return analytics.rate_by(orders, "o_orderpriority", "finished")


@_query
def origin_stats(spark, sf_dir):
    return analytics.origin_stats(flights_table(spark, sf_dir))


@_query
def top_origins(spark, sf_dir):
    return analytics.top_origins(flights_table(spark, sf_dir), min_flights=600)


@_query
def correlation_matrix(spark, sf_dir):
    return analytics.correlation_matrix(flights_table(spark, sf_dir)).withColumn(
        "correlation", F.round("correlation", 6)
    )


def _delay_histogram(spark, sf_dir, column) -> DataFrame:
    delayed = features.delayed_flights(flights_table(spark, sf_dir))
    return analytics.histogram(delayed, column)


@_query
def hist_departure(spark, sf_dir):
    return _delay_histogram(spark, sf_dir, "departure_delay_minutes")


@_query
def hist_arrival(spark, sf_dir):
    return _delay_histogram(spark, sf_dir, "arrival_delay_minutes")


@_query
def uplift_weather(spark, sf_dir):
    """Thunderstorms against calm weather."""
    kind = F.col("weather_origin")
    return analytics.rate_uplift(
        flights_table(spark, sf_dir), kind == "Thunderstorm", kind.isin(*rules.CALM_WEATHER)
    )


@_query
def uplift_peak(spark, sf_dir):
    return analytics.rate_uplift(flights_table(spark, sf_dir), rules.is_peak(_departure_hour()))


@_query
def uplift_hub(spark, sf_dir):
    return analytics.rate_uplift(flights_table(spark, sf_dir), _is_hub())


# ---- predictions by rule and their quality ---------------------------------------------------


def _rule_scored(spark, sf_dir) -> DataFrame:
    """Flights scored by the delay rule itself: a prediction other engines repeat."""
    milli = rules.delay_probability_milli(F.col("weather_origin"), _departure_hour(), _is_hub())
    return flights_table(spark, sf_dir).select(
        "flight_id",
        "weather_origin",
        "is_delayed",
        (milli.cast("double") / F.lit(1000.0)).alias("score"),
        (milli >= 300).cast("double").alias("prediction"),
    )


@_query
def metric_auc(spark, sf_dir):
    auc = metrics.area_under_roc(_rule_scored(spark, sf_dir))
    return auc.select(F.round("auc", 9).alias("auc"))


@_query
def metric_confusion(spark, sf_dir):
    return metrics.confusion(_rule_scored(spark, sf_dir))


@_query
def classification_metrics(spark, sf_dir):
    counts = metrics.confusion(_rule_scored(spark, sf_dir))
    found = metrics.classification_metrics(counts)
    return found.select(*[F.round(c, 9).alias(c) for c in found.columns])


_QUERIES["metrics"] = _QUERIES.pop("classification_metrics")


@_query
def recall_delayed(spark, sf_dir):
    return metrics.recall_of(metrics.confusion(_rule_scored(spark, sf_dir)))


# ---- learning ---------------------------------------------------------------------------------


def _prepared(spark, sf_dir) -> DataFrame:
    return features.prepare(flights_table(spark, sf_dir))


def _split(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    return learning.hash_split(_prepared(spark, sf_dir), bucket=learning.portable_bucket)


@_query
def split_counts(spark, sf_dir):
    """Sizes of the repeatable split, with the label balance of each side."""
    bucket = learning.portable_bucket(F.col("flight_id"))
    side = F.when(bucket < CHECK_SETTINGS.train_percent, "train").otherwise("test")
    return (
        flights_table(spark, sf_dir)
        .groupBy(side.alias("side"))
        .agg(F.count("*").alias("n"), F.avg("is_delayed").alias("delay_rate"))
    )


def _split_facts(sides: tuple[DataFrame, DataFrame]) -> DataFrame:
    """Of a split of distinct ids: rows of both sides together, ids on both, and
    whether the first side has about its share."""
    train, test = (d.select("flight_id", F.lit(t).alias("t")) for d, t in zip(sides, (1, 0)))
    per_id = train.unionAll(test).groupBy("flight_id").agg(
        F.count("*").alias("n"), F.sum("t").alias("n_train")
    )
    share = F.sum("n_train").cast("double") / F.sum("n").cast("double")
    return per_id.agg(
        F.sum("n").alias("n"),
        F.count_if(F.col("n") > 1).alias("n_on_both"),
        (F.abs(share - CHECK_SETTINGS.train_percent / 100) < 0.03).alias("share_holds"),
    )


# Rows of the flight table for one task that keeps and sorts ids.
_IDS_PER_PART = 500_000


def _ids(spark, sf_dir) -> DataFrame:
    """Distinct ids in parts of a bounded number of flights. Adaptive execution
    would merge parts up to so many compressed bytes, and ids compress well."""
    flights = flights_table(spark, sf_dir)
    parts = max(spark.sparkContext.defaultParallelism, flights.count() // _IDS_PER_PART + 1)
    return flights.select("flight_id").repartition(parts, "flight_id").distinct()


@_query
def split_random(spark, sf_dir):
    """Spark's seeded split."""
    return _split_facts(learning.random_split(_ids(spark, sf_dir)))


@_query
def split_default(spark, sf_dir):
    """The split by the engine's own hash, the library's default."""
    return _split_facts(learning.hash_split(_ids(spark, sf_dir)))


def _category_values(df: DataFrame) -> DataFrame:
    """One row per category value, the other category columns NULL, with its
    name: one pass for all columns."""
    sets = [[F.col(c)] for c in CATEGORICAL_FEATURES]
    singles = df.groupingSets(sets, *CATEGORICAL_FEATURES).agg(F.count("*").alias("n"))
    known = F.coalesce(*CATEGORICAL_FEATURES)
    name = F.coalesce(*[F.when(F.col(c).isNotNull(), c) for c in CATEGORICAL_FEATURES])
    return singles.where(known.isNotNull()).withColumns({"category": name, "value": known})


def _of_category(pattern: str, value=F.col):
    picks = [
        F.when(F.col("category") == c, value(pattern.format(c))) for c in CATEGORICAL_FEATURES
    ]
    return F.coalesce(*picks)


@_query
def category_index(spark, sf_dir):
    """Index of every category value, from the dictionary table."""
    entries = dictionary.dictionary(_prepared(spark, sf_dir), CATEGORICAL_FEATURES)
    return entries.select("category", "value", "n", "index")


@_query
def category_encoded(spark, sf_dir):
    """Rows encoded by a dictionary of the training side, beside the indexer
    that was fitted on the same rows: both must give one index."""
    train, test = _split(spark, sf_dir)
    entries = dictionary.dictionary(train, ["origin", "carrier"])
    # a value no training row has
    rows = test.withColumn(
        "origin", F.when(F.col("weather_origin") == "Snow", "nowhere").otherwise(F.col("origin"))
    )
    encoded = dictionary.encode(rows, entries, ["origin", "carrier"])
    return encoded.select(
        "flight_id", *[F.col(f"{c}_index").cast("bigint").alias(f"{c}_index") for c in ("origin", "carrier")]
    )


@_query
def indexer_index(spark, sf_dir):
    """Index the fitted stage gives every category value."""
    rows = _prepared(spark, sf_dir)
    indexer = learning.fit_features(rows).stages[0]
    found = indexer.transform(_category_values(rows))
    return found.select(
        "category", "value", "n", _of_category("{}_index").cast("bigint").alias("index")
    )


@_query
def onehot_width(spark, sf_dir):
    """Width of every one-hot vector and the slot each value occupies."""
    rows = _prepared(spark, sf_dir)
    indexer, encoder, _ = learning.fit_features(rows).stages
    encoded = encoder.transform(indexer.transform(_category_values(rows)))
    # size and slot of the sparse form; a dense array per value would hold V x V numbers
    sparse = _of_category("{}_encoded", lambda c: F.to_json(F.struct(F.col(c).alias("v"))))
    return encoded.select("category", "value", sparse.alias("s")).select(
        "category",
        "value",
        F.get_json_object("s", "$.v.size").cast("bigint").alias("width"),
        F.get_json_object("s", "$.v.indices[0]").cast("bigint").alias("slot"),
    )


@_query
def assembled(spark, sf_dir):
    """Assembled rows of both split sides: vector width and its numeric tail."""
    train, _ = _split(spark, sf_dir)
    fitted = learning.fit_features(train)
    width = learning.vector_width(fitted)
    tail = list(range(width - len(NUMERIC_FEATURES), width))
    vectors = fitted.transform(_prepared(spark, sf_dir))
    cut = VectorSlicer(inputCol="features", outputCol="tail", indices=tail).transform(vectors)
    values = cut.select("flight_id", vector_to_array("tail").alias("t"))
    return values.select(
        "flight_id",
        F.lit(width).cast("bigint").alias("width"),
        *[F.get("t", F.lit(i)).alias(c) for i, c in enumerate(NUMERIC_FEATURES)],
    )


# The check queries share one fitted model per session and data set.
_MODELS: dict[tuple[str, str], learning.DelayModel] = {}


def _fit(spark, sf_dir) -> learning.DelayModel:
    train, _ = _split(spark, sf_dir)
    model = learning.fit_model(train, CHECK_SETTINGS)
    _MODELS[spark.sparkContext.applicationId, sf_dir] = model
    return model


def _model(spark, sf_dir) -> learning.DelayModel:
    known = _MODELS.get((spark.sparkContext.applicationId, sf_dir))
    return known or _fit(spark, sf_dir)


@_query
def gbt_train(spark, sf_dir):
    """A fresh fit, measured on the test side: rows, and whether the measures
    are where these data put them."""
    _, test = _split(spark, sf_dir)
    model = _fit(spark, sf_dir)
    used = model.classifier.getNumTrees
    found = learning.evaluate(model.score(test), CHECK_SETTINGS)
    facts = test.agg(F.count("*").alias("n"), F.avg("is_delayed").alias("rate")).select(
        F.struct("n", "rate").alias("f")
    )
    majority = F.greatest(F.col("f.rate"), F.lit(1.0) - F.col("f.rate"))
    return found.withColumn("f", facts.scalar()).select(
        F.col("f.n").alias("n"),
        F.lit(1 <= used <= CHECK_SETTINGS.trees).alias("trees_in_range"),
        F.col("auc").between(0.62, 0.70).alias("auc_in_range"),
        (F.abs(F.col("accuracy") - majority) < 0.02).alias("accuracy_near_majority"),
        (F.abs(F.col("weighted_recall") - F.col("accuracy")) < 1e-9).alias("recall_is_accuracy"),
    )


def _status_agrees():
    verdict = F.when(F.col("prediction") == 1.0, "DELAYED").otherwise("ON TIME")
    return (F.col("prediction").isin(0.0, 1.0) & (F.col("delay_status") == verdict)).alias(
        "status_agrees"
    )


_PASSED = [c for c in SCORED_COLUMNS if c not in ("prediction", "delay_status")]


@_query
def gbt_predict(spark, sf_dir):
    """Scored test rows: what is passed through, and whether the status says
    what the prediction does."""
    _, test = _split(spark, sf_dir)
    scored = learning.scored_rows(_model(spark, sf_dir).score(test))
    return scored.select(*_PASSED, _status_agrees())


@_query
def model_roundtrip(spark, sf_dir):
    """Scores before saving against scores after loading, on the test side."""
    model = _model(spark, sf_dir)
    paths = scratch_folder(spark, "features"), scratch_folder(spark, "trees")
    model.save(*paths)
    loaded = learning.DelayModel.load(*paths)
    _, test = _split(spark, sf_dir)

    def chance(column):
        return F.get(vector_to_array(column), F.lit(1))

    before = model.score(test).select(
        *test.columns, chance("probability").alias("chance_before")
    )
    after = loaded.score(before)
    return after.agg(
        F.count("*").alias("n"),
        F.count_if(chance("probability") != F.col("chance_before")).alias("n_changed"),
    )


# ---- streaming -----------------------------------------------------------------------------------


def _send(spark, rows: DataFrame, path: str) -> None:
    feed.send_records(feed.keyed_records(rows), kind="files", path=path)


def _drain(stream: DataFrame, checkpoint: str, out: str) -> None:
    scoring.run(scoring.write_stream(stream, checkpoint, kind="parquet", path=out, once=True))


def _through_stream(spark, sf_dir, transform) -> DataFrame:
    """Send all flights through the file twin of the feed and read the sink."""
    source, checkpoint, out = (scratch_folder(spark, p) for p in ("feed", "progress", "sink"))
    _send(spark, flights_table(spark, sf_dir), source)
    _drain(transform(feed.read_records(spark, "files", source)), checkpoint, out)
    return spark.read.parquet(out)


@_query
def stream_parse(spark, sf_dir):
    return _through_stream(spark, sf_dir, scoring.parse_records)


@_query
def stream_features(spark, sf_dir):
    return _through_stream(
        spark,
        sf_dir,
        lambda records: features.prepare(scoring.parse_records(records)).select(
            "flight_id", *NUMERIC_FEATURES
        ),
    )


@_query
def stream_score(spark, sf_dir):
    """Scored live rows, compared with the batch scores of the same flights."""
    model = _model(spark, sf_dir)
    live = _through_stream(spark, sf_dir, lambda records: scoring.score_records(records, model))
    batch = learning.scored_rows(model.score(_prepared(spark, sf_dir)))
    known = batch.groupBy(F.col("flight_id").alias("id")).agg(
        F.collect_set("prediction").alias("predictions")
    )
    equal = F.coalesce(F.array_contains("predictions", F.col("prediction")), F.lit(False))
    return live.join(known, F.col("flight_id") == F.col("id"), "left").select(
        *_PASSED, _status_agrees(), equal.alias("equals_batch")
    )


@_query
def stream_resume(spark, sf_dir):
    """Two runs of one query around a second delivery: nothing lost or doubled."""
    source, checkpoint, out = (scratch_folder(spark, p) for p in ("feed", "progress", "sink"))
    first, second = _split(spark, sf_dir)
    for delivery in (first, second):
        _send(spark, delivery.select(*COLUMNS), source)
        records = feed.read_records(spark, "files", source)
        parsed = scoring.parse_records(records).select("flight_id", "origin", "is_delayed")
        _drain(parsed, checkpoint, out)
    return spark.read.parquet(out)


@_query
def stream_recover(spark, sf_dir):
    """A stream that dies inside its first two batches, after the rows were
    written, and is started again each time: every flight comes out once."""
    source, checkpoint, out = (scratch_folder(spark, p) for p in ("feed", "progress", "sink"))
    _send(spark, flights_table(spark, sf_dir), source)
    ledger, died = scoring.Ledger(spark, out), set()

    def write_then_die(parts, batch, write=ledger.write):
        if batch < 2 and batch not in died:
            died.add(batch)
            for name, part in parts.items():
                part.write.mode("overwrite").parquet(ledger._data(batch, name))
            raise RuntimeError("lost in the middle of a batch")
        write(parts, batch)

    ledger.write = write_then_die
    while True:
        records = feed.read_records(spark, "files", source, max_files_per_trigger=1)
        parsed = scoring.parse_records(records).select("flight_id", "origin", "is_delayed")
        before = len(died)
        try:
            scoring.run(scoring.write_once(parsed, checkpoint, ledger))
            return ledger.read()
        except StreamingQueryException:
            if len(died) == before:
                raise


def _damaged(spark, sf_dir) -> DataFrame:
    """The feed with messages cut off, no JSON, no object, and missing."""
    records = feed.keyed_records(flights_table(spark, sf_dir))
    # a column of its own: as an expression each branch below would parse the message again
    records = records.withColumn("carrier", F.get_json_object("value", "$.carrier"))
    carrier = F.col("carrier")
    value = (
        F.when(carrier == "Brand#11", F.substring("value", 1, 40))
        .when(carrier == "Brand#12", F.concat(F.lit("no json: "), F.substring("value", 15, 20)))
        .when(carrier == "Brand#13", F.concat(F.lit("["), F.substring("value", 14, 12), F.lit("]")))
        .when(carrier == "Brand#14", F.lit(None))
        .otherwise(F.col("value"))
    )
    return records.select("key", value.alias("value"))


@_query
def stream_rejects(spark, sf_dir):
    """Unreadable messages go to a table of their own, as they came; the others
    to the flights. Text and number of each, flights by carrier."""
    source, checkpoint, out = (scratch_folder(spark, p) for p in ("feed", "progress", "sink"))
    feed.send_records(_damaged(spark, sf_dir), kind="files", path=source)
    ledger = scoring.Ledger(spark, out)
    checked = scoring.checked_records(feed.read_records(spark, "files", source))
    scoring.run(scoring.write_once(checked, checkpoint, ledger, scoring.good_and_rejected))
    good = ledger.read().select(F.lit("flight").alias("kind"), F.col("carrier").alias("what"))
    bad = ledger.read("rejects").select(F.lit("reject").alias("kind"), F.col("rejected_value").alias("what"))
    return good.unionAll(bad).groupBy("kind", "what").agg(F.count("*").alias("n"))


@_query
def stream_latest(spark, sf_dir):
    """A stream that begins with what is delivered after its start."""
    source, checkpoint, out = (scratch_folder(spark, p) for p in ("feed", "progress", "sink"))
    first, second = _split(spark, sf_dir)
    _send(spark, first.select(*COLUMNS), source)
    started = datetime.now(timezone.utc)
    # modification times of some file systems are whole seconds
    time.sleep(1.1)
    _send(spark, second.select(*COLUMNS), source)
    records = feed.read_records(spark, "files", source, since=started)
    parsed = scoring.parse_records(records).select("flight_id", "origin", "is_delayed")
    _drain(parsed, checkpoint, out)
    return spark.read.parquet(out)


@_query
def stream_monitor(spark, sf_dir):
    """An interval-triggered stream that is ended once all that arrived is handled:
    rows, unreadable and skipped ones over its batches, and rows written."""
    source, checkpoint, out = (scratch_folder(spark, p) for p in ("feed", "progress", "sink"))
    feed.send_records(_damaged(spark, sf_dir), kind="files", path=source)
    records = feed.read_records(spark, "files", source, max_files_per_trigger=2)
    flights = features.prepare(scoring.checked_records(records).drop("rejected_value"))
    query = scoring.write_stream(
        scoring.watched(flights), checkpoint, "parquet", out, interval="1 second"
    )
    scoring.run(query, follow=False)
    seen = monitor.batches(spark, query)
    written = spark.read.parquet(out).agg(F.count("*")).scalar()

    def counted(name):
        return F.sum(F.col("observed")[f"feed.{name}"].cast("bigint"))

    return seen.agg(
        F.sum("rows").alias("rows_reported"),
        counted("unreadable").alias("unreadable"),
        counted("skipped").alias("skipped"),
    ).withColumn("rows_written", written)
