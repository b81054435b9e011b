import random

import pytest
from pyspark.ml.feature import StringIndexer
from pyspark.sql import functions as F

from punctual.operators import dictionary


def _rows(spark, n, values, seed=1):
    """Values with falling frequency, many ties, one with a third of all rows."""
    draw = F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(values * values))
    name = F.concat(F.lit("v"), F.floor(F.sqrt(draw)).cast("string"))
    hot = F.when(F.col("id") % 3 == 0, "hot").otherwise(name)
    return spark.range(n).select("id", F.when(F.col("id") % 50 != 7, hot).alias("a"), name.alias("b"))


@pytest.mark.parametrize("n, values", [(5_000, 40), (600_000, 200_000)])
def test_equals_the_indexer(spark, n, values):
    rows = _rows(spark, n, values)
    entries = dictionary.dictionary(rows, ["a", "b"])
    fitted = StringIndexer(inputCols=["a", "b"], outputCols=["x", "y"], handleInvalid="keep").fit(rows)
    for c, labels in zip(("a", "b"), fitted.labelsArray):
        own = entries.where(F.col("category") == c)
        found = {r["value"]: r["index"] for r in own.collect()}
        assert found == {v: i for i, v in enumerate(labels)}
    counts = {(r.category, r.value): r.n for r in entries.collect()}
    assert counts["a", "hot"] == rows.where("a = 'hot'").count()


def test_encoding(spark):
    rows = spark.createDataFrame([("b",), ("a",), ("c",), ("c",), (None,)], "a string")
    entries = dictionary.dictionary(rows, ["a"])
    assert dictionary.sizes(entries, ["a", "other"]) == {"a": 3, "other": 0}
    more = spark.createDataFrame([("c", 1), ("a", 2), ("b", 3), ("zz", 4), (None, 5)], "a string, n int")
    got = dictionary.encode(more, entries, ["a"])
    assert got.columns == ["a", "n", "a_index"]
    assert [r.a_index for r in got.orderBy("n").collect()] == [0.0, 1.0, 2.0, 3.0, 3.0]


def test_empty_table(spark):
    rows = spark.createDataFrame([], "a string")
    entries = dictionary.dictionary(rows, ["a"])
    assert entries.count() == 0
    assert dictionary.encode(rows, entries, ["a"]).count() == 0


def test_bitmaps_count_distinct_values(spark, capsys):
    rows = _rows(spark, 200_000, 60_000).withColumn("day", F.col("id") % 5)
    entries = dictionary.dictionary(rows, ["a", "b"])
    bitmaps = dictionary.distinct_bitmaps(rows, entries, ["a", "b"], ["day"])
    total = {r.category: r.n for r in dictionary.merged_distinct(bitmaps).collect()}
    assert total == {c: rows.select(c).where(f"{c} IS NOT NULL").distinct().count() for c in "ab"}
    per_day = {(r.day, r.category): r.n for r in dictionary.merged_distinct(bitmaps, ["day"]).collect()}
    want = rows.groupBy("day").agg(F.count_distinct("a").alias("a"), F.count_distinct("b").alias("b"))
    assert per_day == {(r.day, c): r[c] for r in want.collect() for c in "ab"}
    dictionary.merged_distinct(bitmaps).explain()
    assert "Expand" not in capsys.readouterr().out


def test_ranges_do_not_move(spark):
    random.seed(1)
    rows = spark.createDataFrame([(f"v{random.randrange(999)}",) for _ in range(4000)], "a string")
    entries = dictionary.dictionary(rows.repartition(7), ["a"])
    index = sorted(r["index"] for r in entries.collect())
    assert index == list(range(len(index)))
