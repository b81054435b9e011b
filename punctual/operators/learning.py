"""Feature stages, split, boosted trees, scoring and storage on Spark ML."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import Bucketizer, OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from punctual.operators import boosting, metrics
from punctual.operators.features import delay_status, prepare
from punctual.schema import SCORED_COLUMNS
from punctual.session import ensure_checkpoint_dir
from punctual.settings import DEFAULTS, Settings


# ---- features ---------------------------------------------------------------


def feature_stages(settings: Settings = DEFAULTS) -> Pipeline:
    """Index, one-hot encode, assemble; or index and assemble.

    The multi-column stages fit all categories in one job. Unseen and missing
    categories get an extra index and an all-zero vector; rows with a missing
    number are dropped. The labels of a fitted indexer live on the driver and
    in every task.

    With ``encoding="index"`` a category is one nominal slot instead of one slot
    per value, which trees split on sets of values: tree input then holds as
    many numbers a row as there are columns, however many values they have.
    """
    index = [f"{c}_index" for c in settings.categorical]
    encoded = [f"{c}_encoded" for c in settings.categorical]
    indexer = StringIndexer(
        inputCols=list(settings.categorical), outputCols=index, handleInvalid="keep"
    )
    onehot = settings.encoding == "onehot"
    assembler = VectorAssembler(
        inputCols=(encoded if onehot else index) + list(settings.numeric),
        outputCol="features",
        handleInvalid="skip",
    )
    encoder = [OneHotEncoder(inputCols=index, outputCols=encoded)] if onehot else []
    return Pipeline(stages=[indexer, *encoder, assembler])


def slot_limits(values: int, slots: int) -> list[float]:
    """Limits that put indices 0..``values`` (the last one for unseen values)
    into at most ``slots`` bins.

    Indices fall by frequency: the most frequent half of the slots keep a value
    each, the tail is cut into bins of about equally many values.
    """
    if values + 1 <= slots:
        inner = [float(i) for i in range(1, values + 1)]
    else:
        own = slots // 2
        step = (values + 1 - own) / (slots - own)
        inner = [float(i) for i in range(1, own + 1)]
        inner += [float(round(own + step * i)) for i in range(1, slots - own)]
    # a column without any value still needs a limit
    return [-math.inf, *(inner or [1.0]), math.inf]


def _fit_binned(train: DataFrame, settings: Settings) -> PipelineModel:
    """Indices binned into few nominal slots, whatever the number of values: a
    split then sorts at most ``category_slots`` sets of values, and deep trees
    cannot tell rare values apart by chance."""
    index = [f"{c}_index" for c in settings.categorical]
    binned = [f"{c}_slot" for c in settings.categorical]
    indexer = StringIndexer(
        inputCols=list(settings.categorical), outputCols=index, handleInvalid="keep"
    ).fit(train)
    limits = [slot_limits(len(v), settings.category_slots) for v in indexer.labelsArray]
    bins = Bucketizer(inputCols=index, outputCols=binned, splitsArray=limits)
    assembler = VectorAssembler(
        inputCols=binned + list(settings.numeric), outputCol="features", handleInvalid="skip"
    )
    return PipelineModel(stages=[indexer, bins, assembler])


def fit_features(train: DataFrame, settings: Settings = DEFAULTS) -> PipelineModel:
    """Fit the stages on prepared training rows."""
    if settings.encoding == "binned":
        return _fit_binned(train, settings)
    return feature_stages(settings).fit(train)


def category_labels(features: PipelineModel, settings: Settings = DEFAULTS) -> dict[str, list[str]]:
    """Labels per category in index order."""
    return dict(zip(settings.categorical, features.stages[0].labelsArray))


def vector_width(features: PipelineModel, settings: Settings = DEFAULTS) -> int:
    labels = category_labels(features, settings)
    if settings.encoding != "onehot":
        return len(labels) + len(settings.numeric)
    return sum(len(v) for v in labels.values()) + len(settings.numeric)


# ---- split ------------------------------------------------------------------


def split_bucket(key: Column) -> Column:
    """0..99 from the JVM's 64-bit hash of the key."""
    return F.pmod(F.xxhash64(key), F.lit(100))


def portable_bucket(key: Column) -> Column:
    """0..99 from the key's MD5 digest, which other SQL engines can repeat."""
    digest = F.md5(F.coalesce(key, F.lit("")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % 100


def hash_split(
    df: DataFrame, settings: Settings = DEFAULTS, bucket=split_bucket
) -> tuple[DataFrame, DataFrame]:
    """Train and test rows by a hash of the key: the same rows on every run,
    whatever the partitioning or the number of lost executors."""
    number = bucket(F.col(settings.split_key))
    return df.where(number < settings.train_percent), df.where(number >= settings.train_percent)


def random_split(df: DataFrame, settings: Settings = DEFAULTS) -> tuple[DataFrame, DataFrame]:
    """Spark's seeded split; repeatable only for the same partitions in the
    same order."""
    share = settings.train_percent / 100
    train, test = df.randomSplit([share, 1 - share], seed=settings.seed)
    return train, test


def training_summary(prepared: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """What a fit will see, in one pass: rows and label balance, rows of both split
    sides, rows without a label, and rows dropped for a missing number."""
    train = split_bucket(F.col(settings.split_key)) < settings.train_percent
    known = F.col(settings.label).isNotNull()
    kinds = dict(prepared.dtypes)
    missing = F.lit(False)
    for c in settings.numeric:
        missing = missing | F.col(c).isNull()
        if kinds[c] in ("double", "float"):
            missing = missing | F.coalesce(F.isnan(c), F.lit(False))
    counts = prepared.agg(
        F.count("*").alias("total"),
        F.count_if(F.col(settings.label) == 1).alias("delayed"),
        F.count_if(F.col(settings.label) == 0).alias("not_delayed"),
        F.count_if(train).alias("train_rows"),
        F.count_if(~train).alias("test_rows"),
        F.count_if(~known).alias("unlabelled"),
        F.count_if(missing).alias("skipped"),
    )
    labelled = (F.col("delayed") + F.col("not_delayed")).cast("double")
    percent = F.try_divide(F.col("delayed") * F.lit(100.0), labelled)
    return counts.withColumn("percent_delayed", percent)


# ---- training and scoring -----------------------------------------------------


#: Column that marks the rows which decide how many trees are kept.
_HELD_OUT = "__held_out"

#: Rows of one part of the tree input, which one task keeps as objects.
_MOST_PER_PART = 2_000_000


def fit_trees(
    vectors: DataFrame,
    settings: Settings = DEFAULTS,
    most_values: int = 0,
    drawn: DataFrame | None = None,
) -> GBTClassificationModel:
    """Gradient-boosted trees on assembled rows. A nominal slot needs a bin for
    each of its at most ``most_values`` values; the limits of numeric slots come
    from the ``drawn`` rows, if given.

    Margins are checkpointed every few trees, so that the lineage of a long
    run stays short and a lost executor recomputes little. Rows marked as held
    out, if there is such a column, are not learned from: ``trees`` is then an
    upper bound, and boosting ends where the loss on them stops to fall.
    """
    ensure_checkpoint_dir(vectors.sparkSession)
    booster = GBTClassifier(
        labelCol=settings.label,
        featuresCol="features",
        maxIter=settings.trees,
        maxDepth=settings.depth,
        stepSize=settings.step_size,
        seed=settings.seed,
        checkpointInterval=settings.checkpoint_every,
        maxBins=max(32, most_values),
    )
    columns = ["features", settings.label]
    if _HELD_OUT in vectors.columns:
        booster.setValidationIndicatorCol(_HELD_OUT)
        booster.set(booster.validationTol, settings.validation_tolerance)
        columns.append(_HELD_OUT)
    return boosting.fit(booster, vectors.select(*columns), drawn, tree_parts)


@dataclass(frozen=True)
class DelayModel:
    """Fitted feature stages and classifier, saved and loaded together."""

    features: PipelineModel
    classifier: GBTClassificationModel

    def score(self, prepared: DataFrame) -> DataFrame:
        """Add score columns to prepared rows of a table or a stream."""
        return self.classifier.transform(self.features.transform(prepared))

    def save(self, features_path: str, classifier_path: str) -> None:
        self.features.write().overwrite().save(features_path)
        self.classifier.write().overwrite().save(classifier_path)

    @staticmethod
    def load(features_path: str, classifier_path: str) -> DelayModel:
        return DelayModel(
            PipelineModel.load(features_path), GBTClassificationModel.load(classifier_path)
        )


def tree_parts(rows: int, cores: int) -> int:
    """Parts of the tree input: one per core, of at most ``_MOST_PER_PART`` rows."""
    return max(cores, math.ceil(rows / _MOST_PER_PART))


def fit_model(train: DataFrame, settings: Settings = DEFAULTS) -> DelayModel:
    """Fit feature stages and trees on prepared training rows only.

    The source is read for the categories, for its number of rows, for the limits of
    numeric slots (Spark ML's number of rows, drawn before they become vectors) and
    for the packed rows, which the trees keep. Rows move, by a hash of what they
    hold, only where they lie in fewer parts than there are cores.
    """
    labelled = train.where(F.col(settings.label).isNotNull())
    features = fit_features(labelled, settings)
    columns = [F.col("features"), F.col(settings.label)]
    if settings.validation_percent:
        # another hash than the split's, so that both are independent
        draw = F.pmod(F.xxhash64(settings.split_key, F.lit("held out")), F.lit(100))
        columns.append((draw < settings.validation_percent).alias(_HELD_OUT))
    values = max((len(v) for v in category_labels(features, settings).values()), default=0) + 1
    most = values if settings.encoding == "index" else 0

    # twice as many, as some are held out and some lack a number
    rows, wanted = labelled.count(), 2 * boosting.sampled_rows(max(32, most))
    some = labelled if rows <= wanted else labelled.sample(False, wanted / rows, settings.seed)
    cores = labelled.sparkSession.sparkContext.defaultParallelism
    if labelled.rdd.getNumPartitions() < cores:
        inputs = {*settings.categorical, *settings.numeric, settings.split_key, settings.label}
        even = labelled.repartition(cores, *[c for c in labelled.columns if c in inputs])
    else:
        even = labelled.coalesce(cores)
    vectors, drawn = (features.transform(d).select(*columns) for d in (even, some))
    return DelayModel(features, fit_trees(vectors, settings, most, drawn))


def scored_rows(scored: DataFrame) -> DataFrame:
    """The eight reported columns of scored rows."""
    return scored.withColumn("delay_status", delay_status(F.col("prediction"))).select(
        *SCORED_COLUMNS
    )


def evaluate(scored: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """AUC, accuracy, weighted precision, recall and F1 as one row.

    The trees run once: label, prediction and score are kept while the two
    small aggregations read them.
    """
    narrow = scored.select(
        settings.label,
        "prediction",
        F.get(vector_to_array("probability"), F.lit(1)).alias("score"),
    ).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        by_class = metrics.classification_metrics(metrics.confusion(narrow, settings.label)).first()
        auc = metrics.area_under_roc(narrow, "score", settings.label).first()
    finally:
        narrow.unpersist()
    row = {**auc.asDict(), **by_class.asDict()}
    return scored.sparkSession.range(1).select(
        *[F.lit(v).cast("double").alias(k) for k, v in row.items()]
    )


def train_and_evaluate(
    flights: DataFrame, settings: Settings = DEFAULTS
) -> tuple[DelayModel, DataFrame]:
    """Prepare, split, fit on the training rows, measure on the others."""
    train, test = hash_split(prepare(flights), settings)
    model = fit_model(train, settings)
    return model, evaluate(model.score(test), settings)
