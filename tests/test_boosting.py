"""The packed trees are Spark ML's trees."""

import numpy as np
import pytest
from pyspark.errors import PythonException
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from punctual.operators import boosting


def _rows(spark, n=4000, nominal=True):
    """Numbers, a nominal slot of seven values, a label that depends on both, and a mark."""
    draw = lambda salt, most: F.pmod(F.xxhash64("id", F.lit(salt)), F.lit(most))
    rows = spark.range(n, numPartitions=3).select(
        "id",
        draw("a", 1000).cast("double").alias("a"),
        (draw("b", 9) - 4).cast("double").alias("b"),
        draw("c", 7).cast("double").alias("c"),
        (draw("m", 5) == 0).alias("marked"),
        draw("y", 100).alias("luck"),
    )
    chance = F.col("a") / 20 + F.when(F.col("c").isin(2.0, 5.0), 30).otherwise(0) + F.abs("b") * 3
    rows = rows.withColumn("y", (F.col("luck") < chance).cast("double"))
    if nominal:
        about = {"ml_attr": {"type": "nominal", "name": "c", "num_vals": 7}}
        rows = rows.withColumn("c", F.col("c").alias("c", metadata=about))
    return VectorAssembler(inputCols=["a", "c", "b"], outputCol="features").transform(rows)


def _booster(**more):
    return GBTClassifier(labelCol="y", **({"maxIter": 3, "maxDepth": 4, "seed": 1} | more))


def _chances(model, rows):
    scored = model.transform(rows).select("id", F.get(vector_to_array("probability"), F.lit(1)))
    return dict(tuple(r) for r in scored.collect())


@pytest.mark.parametrize("more", [{}, {"maxDepth": 7, "maxIter": 2}, {"maxBins": 10, "stepSize": 0.3}])
@pytest.mark.parametrize("nominal", [True, False])
def test_trees_are_those_of_spark_ml(spark, more, nominal):
    rows = _rows(spark, nominal=nominal)
    own, other = boosting.fit(_booster(**more), rows), _booster(**more).fit(rows)
    assert own.treeWeights == other.treeWeights and own.numFeatures == other.numFeatures == 3
    assert own.getMaxDepth() == other.getMaxDepth() and own.getStepSize() == other.getStepSize()
    expected = _chances(other, rows)
    away = [abs(p - expected[i]) for i, p in _chances(own, rows).items()]
    # two splits may gain the same for few rows, and either is right
    assert len(away) == 4000 and np.mean([a > 1e-9 for a in away]) < 0.01
    if not more:
        assert max(away) < 1e-9 and own.totalNumNodes == other.totalNumNodes
        assert own.featureImportances.toArray() == pytest.approx(other.featureImportances.toArray())


def test_boosting_ends_where_spark_ml_ends_it(spark):
    rows = _rows(spark)
    more = {"maxIter": 40, "maxDepth": 5, "validationIndicatorCol": "marked", "validationTol": 0.0}
    own, other = boosting.fit(_booster(**more), rows), _booster(**more).fit(rows)
    assert 1 < own.getNumTrees == other.getNumTrees < 40


def test_one_job_a_level(spark):
    """Spark ML runs some twenty jobs for a tree of this depth."""
    rows, context = _rows(spark).cache(), spark.sparkContext
    rows.count()
    jobs = []
    for trees in (1, 5):
        context.setJobGroup(f"trees-{trees}", "")
        boosting.fit(_booster(maxIter=trees, maxDepth=8), rows)
        jobs.append(len(context.statusTracker().getJobIdsForGroup(f"trees-{trees}")))
    context.setLocalProperty("spark.jobGroup.id", None)
    rows.unpersist()
    assert 4 <= jobs[1] - jobs[0] <= 4 * 8


def test_a_row_takes_few_bytes(spark):
    """Spark ML keeps an integer per slot; a code of two bytes holds ten binary slots."""
    bins = boosting.layout([None] * 450, {i: 2 for i in range(450)})
    assert len(bins.sizes) == 45 and set(bins.sizes) == {1024}
    rows = np.random.default_rng(1).integers(0, 2, (100, 450)).astype(float)
    assert bins.pack(rows).nbytes == 100 * 45 * 2


@pytest.mark.parametrize("parts", [1, 5, 40])
def test_same_trees_at_any_partitioning(spark, parts):
    rows = _rows(spark)
    expected = _chances(boosting.fit(_booster(), rows), rows)
    dealt = rows.repartition(parts, "a")
    assert _chances(boosting.fit(_booster(), dealt, dealt, lambda n, cores: parts), rows) == expected


def test_same_trees_when_nodes_and_rows_are_counted_in_steps(spark, monkeypatch):
    rows = _rows(spark)
    expected = _chances(boosting.fit(_booster(), rows), rows)
    monkeypatch.setattr(boosting, "_HISTOGRAM_BYTES", 1)
    monkeypatch.setattr(boosting, "_BLOCK_BYTES", 3000)
    assert _chances(boosting.fit(_booster(), rows), rows) == expected


def test_checkpoints_are_removed(spark):
    found = boosting.fit(_booster(maxIter=5, checkpointInterval=2), _rows(spark))
    assert found.getNumTrees == 5


def test_codes_hold_all_bins():
    draw = np.random.default_rng(2)
    limits = [np.arange(31) + 0.5, None, np.array([]), np.array([0.0]), None]
    bins = boosting.layout(limits, {1: 2000, 4: 16})
    values = np.stack([draw.integers(0, 32, 500), draw.integers(0, 2000, 500), np.ones(500),
                       draw.integers(-1, 2, 500), draw.integers(0, 16, 500)], axis=1).astype(float)
    codes, expected = bins.pack(values), [values[:, 0], values[:, 1], 0 * values[:, 2], values[:, 3] > 0, values[:, 4]]
    for slot, want in enumerate(expected):
        assert (bins.bin_of(slot)[codes[bins.group[slot]]] == want).all()
    counted = [np.bincount(c, minlength=size)[None, :].astype(float) for c, size in zip(codes, bins.sizes)]
    found, starts = bins.spread(counted)[0], bins.starts
    for slot, want in enumerate(expected):
        plain = np.bincount(want.astype(int), minlength=bins.bins[slot])
        assert (found[starts[slot] : starts[slot + 1]] == plain).all()
    with pytest.raises(ValueError, match="beyond"):
        bins.pack(np.array([[0.0, 2000.0, 0.0, 0.0, 0.0]]))


@pytest.mark.parametrize("levels", [0, 1, 6, 7, 9])
def test_rows_reach_their_nodes(levels):
    """However deep the tree, and whether rows end early or late."""
    draw = np.random.default_rng(levels)
    bins = boosting.layout([np.arange(7) + 0.5, None, np.arange(30) + 0.5, None], {1: 16, 3: 1500})
    values = np.stack([draw.integers(0, b, 40_000) for b in bins.bins], axis=1).astype(float)
    tree = boosting.Tree(1000.0, 0.0)
    for level in range(levels):
        ends = [n for n in range(len(tree)) if tree.level[n] == level]
        for node in ends[:: 1 if level < 3 else 2] or ends:
            slot = int(draw.integers(0, 4))
            tree.split(node, slot, draw.random(bins.bins[slot]) < 0.5, 1.0, 10.0, 1.0)
    node = np.zeros(len(values), int)
    for _ in range(levels):
        for n in range(len(tree)):
            at = np.flatnonzero(node == n)
            if tree.slot[n] >= 0 and tree.level[n] == _:
                left = tree.goes_left[n][values[at, tree.slot[n]].astype(int)]
                node[at] = np.where(left, tree.left[n], tree.right[n])
    assert (tree.walk(bins)(bins.pack(values)) == node).all()


def test_limits_of_numeric_slots():
    assert boosting.split_points(np.array([3.0, 1.0, 1.0]), 32).tolist() == [2.0]
    assert boosting.split_points(np.ones(5), 32).tolist() == []
    many = boosting.split_points(np.arange(1000.0), 10)
    assert len(many) == 9 and np.diff(many) == pytest.approx(100, abs=1)


def test_labels_and_slots_are_checked(spark):
    rows = _rows(spark, 50)
    with pytest.raises(PythonException, match="neither 0 nor 1"):
        boosting.fit(_booster(), rows.withColumn("y", F.col("y") + 1))
    with pytest.raises(ValueError, match="maxBins"):
        boosting.fit(_booster(maxBins=5), rows)
    with pytest.raises(ValueError, match="no rows"):
        boosting.fit(_booster(), rows.where("id < 0"))
