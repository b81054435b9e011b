from dataclasses import replace

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from punctual.operators import features, learning
from punctual.plans.flights import flights_table
from punctual.schema import CATEGORICAL_FEATURES, COLUMNS, NUMERIC_FEATURES, SCORED_COLUMNS
from punctual.settings import Settings
from punctual.sources import feed
from punctual.streaming import scoring

SMALL = Settings(trees=3, depth=3)


@pytest.fixture(scope="module")
def prepared(spark, small):
    rows = features.prepare(flights_table(spark, small)).cache()
    yield rows
    rows.unpersist()


def _tiny(spark, categories, number=1.0):
    rows = spark.createDataFrame([(c,) for c in categories], "carrier string")
    others = {c: F.lit("x") for c in CATEGORICAL_FEATURES if c != "carrier"}
    return rows.withColumns(others | {c: F.lit(number) for c in NUMERIC_FEATURES})


def test_labels_by_frequency_then_name_and_unseen_is_empty(spark):
    fitted = learning.fit_features(_tiny(spark, ["b", "a", "c", "c"]))
    assert learning.category_labels(fitted)["carrier"] == ["c", "a", "b"]
    assert learning.vector_width(fitted) == 3 + 4 + 9
    rows = fitted.transform(_tiny(spark, ["c", "b", "zz", None])).select(
        "carrier_index", vector_to_array("carrier_encoded"), vector_to_array("features")
    )
    found = [(r[0], r[1]) for r in rows.collect()]
    assert found == [(0.0, [1, 0, 0]), (2.0, [0, 0, 1]), (3.0, [0, 0, 0]), (3.0, [0, 0, 0])]
    assert all(len(r[2]) == 16 for r in rows.collect())


@pytest.mark.parametrize("bad", [None, float("nan")])
def test_rows_without_a_number_are_dropped(spark, bad):
    fitted = learning.fit_features(_tiny(spark, ["a"]))
    rows = _tiny(spark, ["a", "b"]).withColumn(
        "taxi_in_minutes", F.when(F.col("carrier") == "a", 1.0).otherwise(F.lit(bad).cast("double"))
    )
    assert [r.carrier for r in fitted.transform(rows).collect()] == ["a"]


@pytest.mark.parametrize("encoding", ["onehot", "index"])
def test_wide_categories_train(spark, encoding):
    settings = replace(SMALL, encoding=encoding)
    rows = _tiny(spark, [str(i) for i in range(200)] * 2)
    rows = rows.withColumn("is_delayed", (F.col("carrier").cast("int") % 2).cast("double"))
    model = learning.fit_model(rows, settings)
    assert model.score(rows).count() == 400
    width = 14 if encoding == "index" else 200 + 4 + 9
    assert learning.vector_width(model.features, settings) == width
    if encoding == "index":
        assert model.classifier.getMaxBins() == 201


@pytest.mark.parametrize("bucket", [learning.split_bucket, learning.portable_bucket])
def test_hash_split_is_whole_and_stable(spark, prepared, bucket):
    train, test = learning.hash_split(prepared, SMALL, bucket)
    again, _ = learning.hash_split(prepared.repartition(5), SMALL, bucket)
    n = prepared.count()
    assert train.count() + test.count() == n
    assert 0.77 < train.count() / n < 0.83
    assert train.select("flight_id").exceptAll(again.select("flight_id")).isEmpty()


def test_hash_split_keeps_rows_without_key(spark):
    rows = spark.createDataFrame([(None,), ("a",)], "flight_id string")
    for bucket in (learning.split_bucket, learning.portable_bucket):
        train, test = learning.hash_split(rows, SMALL, bucket)
        assert train.count() + test.count() == 2


def test_random_split_is_whole(spark, prepared):
    train, test = learning.random_split(prepared)
    assert train.count() + test.count() == prepared.count()


@pytest.fixture(scope="module")
def model(prepared):
    return learning.fit_model(learning.hash_split(prepared, SMALL)[0], SMALL)


def test_scored_rows(prepared, model):
    scored = learning.scored_rows(model.score(prepared))
    assert scored.columns == list(SCORED_COLUMNS)
    wrong = scored.where("(prediction = 1) <> (delay_status = 'DELAYED')")
    assert scored.count() == prepared.count() and wrong.isEmpty()


def test_stream_scores_equal_batch_scores(spark, prepared, model, tmp_path):
    source, checkpoint, out = (str(tmp_path / n) for n in ("in", "progress", "out"))
    feed.send_records(feed.keyed_records(prepared.select(*COLUMNS)), "files", source)
    scored = scoring.score_records(feed.read_records(spark, "files", source), model)
    scoring.run(scoring.write_stream(scored, checkpoint, "parquet", out, once=True))
    streamed = spark.read.parquet(out)
    batch = learning.scored_rows(model.score(prepared))
    assert streamed.count() == batch.count()
    assert streamed.exceptAll(batch).isEmpty()


def test_saved_model_scores_alike(prepared, model, tmp_path):
    paths = str(tmp_path / "features"), str(tmp_path / "trees")
    for _ in range(2):  # saving again replaces
        model.save(*paths)
    loaded = learning.DelayModel.load(*paths)
    before = model.score(prepared).select("flight_id", vector_to_array("probability"))
    after = loaded.score(prepared).select("flight_id", vector_to_array("probability"))
    assert before.exceptAll(after).isEmpty()


def test_parameters_reach_the_trees(model):
    trees = model.classifier
    assert (trees.getNumTrees, trees.getMaxDepth(), trees.getStepSize()) == (3, 3, 0.1)
    defaults = Settings()
    assert (defaults.trees, defaults.depth, defaults.step_size, defaults.seed) == (100, 8, 0.1, 42)


def test_quality_is_near_what_the_data_allows(spark, medium):
    settings = Settings(trees=10, depth=4)
    flights = flights_table(spark, medium)
    _, measured = learning.train_and_evaluate(flights, settings)
    row = measured.first()
    share = flights.agg(F.avg("is_delayed")).first()[0]
    assert 0.62 <= row.auc <= 0.70
    assert abs(row.accuracy - (1 - share)) < 0.02
    assert row.weighted_recall == pytest.approx(row.accuracy)


@pytest.mark.parametrize("values, slots", [(0, 4), (3, 4), (4, 4), (25, 16), (1000, 16), (1000, 32)])
def test_slots_of_categories(values, slots):
    limits = learning.slot_limits(values, slots)
    assert limits == sorted(set(limits)) and len(limits) - 1 == max(2, min(values + 1, slots))
    # each of the most frequent values has a slot of its own
    own = min(values + 1, slots // 2)
    assert limits[1 : own + 1] == [float(i) for i in range(1, own + 1)][: len(limits) - 2]


def test_binned_features_and_early_end(spark, prepared):
    settings = replace(SMALL, encoding="binned", category_slots=8, trees=60, validation_percent=20)
    model = learning.fit_model(prepared, settings)
    assert model.classifier.numFeatures == learning.vector_width(model.features, settings) == 14
    assert 1 <= model.classifier.getNumTrees < 60
    slots = model.features.transform(prepared).agg(F.max("origin_slot"), F.min("origin_slot")).first()
    assert 0 <= slots[1] <= slots[0] < 8
    unseen = prepared.withColumn("origin", F.lit("nowhere"))
    assert model.score(unseen).where("prediction IS NULL").count() == 0


def test_fit_rebalances_its_rows(spark, small):
    one = flights_table(spark, small).coalesce(1)
    plan = features.prepare(one).hint("rebalance")._jdf.queryExecution().optimizedPlan().toString()
    assert "RebalancePartitions" in plan


def test_model_survives_saving_when_binned(spark, prepared, tmp_path):
    settings = replace(SMALL, encoding="binned")
    model = learning.fit_model(prepared, settings)
    model.save(str(tmp_path / "f"), str(tmp_path / "t"))
    loaded = learning.DelayModel.load(str(tmp_path / "f"), str(tmp_path / "t"))
    before, after = (sorted(tuple(r) for r in learning.scored_rows(m.score(prepared)).collect()) for m in (model, loaded))
    assert before == after


def test_trees_take_as_few_parts_as_there_are_cores(spark, prepared, monkeypatch):
    """Every tree runs some twenty jobs, each a task per part of its input."""
    seen = {}

    def record(vectors, *_):
        seen["parts"], seen["rows"] = vectors.rdd.getNumPartitions(), vectors.count()

    monkeypatch.setattr(learning, "fit_trees", record)
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        learning.fit_model(prepared, SMALL)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert seen == {"parts": spark.sparkContext.defaultParallelism, "rows": prepared.count()}
    assert learning.tree_parts(10, 12) == 12
    assert learning.tree_parts(156_000_000, 12) == 78
