"""Quality of predictions, as aggregations over label, prediction and score."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from punctual.schema import LABEL


def confusion(df: DataFrame, label: str = LABEL, prediction: str = "prediction") -> DataFrame:
    """Rows per (label, prediction): all the class metrics need."""
    return (
        df.where(F.col(label).isNotNull() & F.col(prediction).isNotNull())
        .groupBy(F.col(label).alias("label"), F.col(prediction).alias("prediction"))
        .agg(F.count("*").alias("n"))
    )


def class_scores(counts: DataFrame) -> DataFrame:
    """Support, hits, precision, recall and F1 per class from a confusion table.

    A class that is never predicted has precision 0.
    """
    n, none = F.col("n"), F.lit(0).cast("bigint")
    hit = F.when(F.col("label") == F.col("prediction"), n).otherwise(none)

    def part(of: str, support: Column, predicted: Column, hits: Column) -> Column:
        return F.struct(
            F.col(of).alias("class"),
            support.alias("support"),
            predicted.alias("predicted"),
            hits.alias("hits"),
        )

    # every count once under its label and once under its prediction
    parts = F.array(part("label", n, none, hit), part("prediction", none, n, none))
    totals = (
        counts.select(F.inline(parts))
        .groupBy("class")
        .agg(*[F.sum(c).alias(c) for c in ("support", "predicted", "hits")])
    )
    hits = F.col("hits").cast("double")

    def share(of: str):
        return F.coalesce(F.try_divide(hits, F.col(of).cast("double")), F.lit(0.0))

    rated = totals.withColumns({"precision": share("predicted"), "recall": share("support")})
    p, r = F.col("precision"), F.col("recall")
    return rated.withColumn("f1", F.coalesce(F.try_divide(p * r * 2, p + r), F.lit(0.0)))


def classification_metrics(counts: DataFrame) -> DataFrame:
    """Accuracy and support-weighted precision, recall and F1, as one row."""
    support = F.col("support").cast("double")
    total = F.sum(support)
    return class_scores(counts).agg(
        F.try_divide(F.sum(F.col("hits").cast("double")), total).alias("accuracy"),
        *[
            F.try_divide(F.sum(F.col(m) * support), total).alias(f"weighted_{m}")
            for m in ("precision", "recall", "f1")
        ],
    )


def recall_of(counts: DataFrame, value: float = 1.0) -> DataFrame:
    """Share of the rows of one class that were caught."""
    is_class = F.col("label") == value
    caught = F.sum(F.when(is_class & (F.col("prediction") == value), F.col("n")).otherwise(0))
    present = F.sum(F.when(is_class, F.col("n")).otherwise(0))
    return counts.agg(
        caught.alias("caught"),
        present.alias("delayed"),
        F.try_divide(caught.cast("double"), present.cast("double")).alias("recall"),
    )


def area_under_roc(
    df: DataFrame, score: str = "score", label: str = LABEL, ranges: int | None = None
) -> DataFrame:
    """Exact area under the ROC curve, ties counted half, as one row; missing
    scores and labels are left out.

    Rows are first reduced to one per score level. Levels are range-partitioned
    by score; each range accumulates its own levels in order, in parallel, and
    only the range totals, one row each, are accumulated in one task. Any ranges
    give the same area, so no score is rounded or binned.
    """
    levels = (
        df.select(F.col(score).alias("score"), F.col(label).alias("label"))
        .where(F.col("score").isNotNull() & F.col("label").isNotNull() & ~F.isnan("score"))
        .groupBy("score")
        .agg(
            F.count_if(F.col("label") == 1).alias("pos"),
            F.count_if(F.col("label") == 0).alias("neg"),
        )
    )
    dealt = levels.repartitionByRange(*([ranges] if ranges else []), "score")
    return _area(dealt.withColumn("range", F.spark_partition_id()))


def _area(levels: DataFrame) -> DataFrame:
    """Share of (positive, negative) pairs in the right order, from the counts
    per score level and the ranges the levels are cut into."""
    below = Window.partitionBy("range").orderBy("score")
    in_range = (
        levels.withColumn("neg_below", F.sum("neg").over(below) - F.col("neg"))
        .groupBy("range")
        .agg(
            F.sum(F.col("pos") * (F.col("neg_below") + F.col("neg") / F.lit(2.0))).alias("area"),
            F.sum("pos").alias("pos"),
            F.sum("neg").alias("neg"),
        )
    )
    before = Window.orderBy("range")
    ranked = in_range.withColumn("neg_before", F.sum("neg").over(before) - F.col("neg"))
    won = F.sum(F.col("area") + F.col("pos") * F.col("neg_before").cast("double"))
    possible = F.sum("pos").cast("double") * F.sum("neg").cast("double")
    return ranked.agg(F.try_divide(won, possible).alias("auc"))
