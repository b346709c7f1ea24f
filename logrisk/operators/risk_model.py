"""Features to a risk model, scores and metrics.

Split and training do not depend on how the input happens to be partitioned: the split is a
hash of the row key, or a cut in time, and the training rows are laid out by that key over a fixed number of
partitions. Another number gives another, equally good forest.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logrisk.functions.buckets import bucket_hour_number, bucket_hours
from logrisk.operators.counts import COUNT_KEY

# The model input, in vector order.
MODEL_INPUTS = (
    "error_frequency",
    "error_distribution",
    "rate_of_change",
    "high_error_flag",
    "source_index",
)


@dataclass(frozen=True)
class ModelParams:
    """Settings of the forest and of the reproducible split.

    ``train_tenths`` of the keys go to training; with ``split="random"`` rows are sampled
    with the seed instead, which changes with the partitioning. With ``split="time"`` training takes the
    first ``train_tenths`` of the hours that the buckets span, and only rows that end ``gap_hours`` before
    the others begin, so that no label of a training row looks into the others' time. Training rows are spread
    over ``partitions``, whatever their number: set it once, to a few times the cores that
    training may use, as the forest depends on it.
    """

    train_tenths: int = 8
    split: str = "key"
    gap_hours: int = 2
    trees: int = 20
    depth: int = 5
    seed: int = 42
    partitions: int = 8

    def __post_init__(self) -> None:
        if self.split not in ("key", "random", "time"):
            raise ValueError(f"split: {self.split!r}")
        if not 0 < self.train_tenths < 10 or self.partitions < 1 or self.gap_hours < 0:
            raise ValueError("train_tenths must lie between 0 and 10, partitions above 0, gap_hours from 0 on")


def row_key() -> Column:
    return F.concat_ws(",", *COUNT_KEY)


def in_training(train_tenths: int = 8) -> Column:
    """True for the keys whose hash falls into the training share."""
    hashed = F.conv(F.substring(F.md5(row_key()), 1, 8), 16, 10).cast("bigint")
    return hashed % 10 < train_tenths


def time_cut(features: DataFrame, params: ModelParams = ModelParams()) -> int:
    """The hour, counted from 1970, at which a split by time begins to test."""
    hour = bucket_hour_number(F.col("date_hour"))
    first, last = features.agg(F.min(hour), F.max(hour)).first()
    if first is None:
        raise ValueError("no bucket is a time")
    return first + (last - first + 1) * params.train_tenths // 10


def side_of(cut: int, gap_hours: int) -> Column:
    """``train``, ``gap`` or ``test`` by the time of a bucket; null for free-form buckets."""
    start = bucket_hour_number(F.col("date_hour"))
    end = start + bucket_hours(F.col("date_hour"))
    return F.when(start >= cut, "test").when(end + gap_hours <= cut, "train").when(start.isNotNull(), "gap")


def split_features(
    features: DataFrame, params: ModelParams = ModelParams()
) -> tuple[DataFrame, DataFrame]:
    """Training and test rows; split by key, the same key is always on the same side.

    Split by time, rows in the gap and rows whose bucket is no time are on neither side.
    """
    if params.split == "random":
        train, test = features.randomSplit(
            [params.train_tenths / 10, 1 - params.train_tenths / 10], seed=params.seed
        )
        return train, test
    if params.split == "time":
        side = side_of(time_cut(features, params), params.gap_hours)
        return features.filter(side == "train"), features.filter(side == "test")
    chosen = in_training(params.train_tenths)
    return features.filter(chosen), features.filter(~chosen)


def source_indexer() -> StringIndexer:
    """``source`` to ``source_index``: most frequent first, ties by name, unseen last."""
    return StringIndexer(inputCol="source", outputCol="source_index", handleInvalid="keep")


_GIVEN_INPUTS = [name for name in MODEL_INPUTS if name != "source_index"]


def is_complete() -> Column:
    """True for rows whose model inputs are all numbers. ``source_index`` always is."""
    known = [F.col(name).isNotNull() & ~F.isnan(F.col(name).cast("double")) for name in _GIVEN_INPUTS]
    return reduce(and_, known)


def train_risk_model(train: DataFrame, params: ModelParams = ModelParams()) -> PipelineModel:
    """Fit indexer, assembler and forest.

    Rows with an unknown input are not learnt from. Raises unless the others hold both labels:
    a forest of one class would give probabilities without a risk entry. The rows are read once
    and kept while fitting.
    """
    rows = train.filter(is_complete()).select(*COUNT_KEY, *_GIVEN_INPUTS, "label")
    laid_out = (
        rows.withColumn("_key", row_key())
        .repartition(params.partitions, "_key")
        .sortWithinPartitions("_key")
        .drop("_key")
        .persist(StorageLevel.MEMORY_AND_DISK)
    )
    assembler = VectorAssembler(
        inputCols=list(MODEL_INPUTS), outputCol="features", handleInvalid="keep"
    )
    forest = RandomForestClassifier(
        numTrees=params.trees, maxDepth=params.depth, seed=params.seed
    )
    try:
        labels = laid_out.agg(F.min("label").alias("low"), F.max("label").alias("high")).head()
        if labels.low == labels.high:
            raise ValueError("training needs rows of both labels")
        return Pipeline(stages=[source_indexer(), assembler, forest]).fit(laid_out)
    finally:
        laid_out.unpersist()


def score_risk(model: PipelineModel, features: DataFrame) -> DataFrame:
    """Add ``prediction``, ``probability`` and ``risk``, the probability of label 1.

    All rows are kept; those with an unknown input have no score.
    """
    scored = model.transform(features).withColumn("risk", vector_to_array("probability")[1])
    scores = ("rawPrediction", "probability", "prediction", "risk")
    return scored.withColumns({name: F.when(is_complete(), F.col(name)) for name in scores})


def evaluate_risk(predictions: DataFrame) -> DataFrame:
    """Accuracy, weighted precision, weighted recall and F1 as one row.

    One aggregation to a confusion table; the rest works on a row per pair of classes. Rows
    without a prediction do not count.
    """
    pairs = predictions.filter("prediction IS NOT NULL").groupBy(
        F.col("label").cast("double").alias("actual"),
        F.col("prediction").cast("double").alias("predicted"),
    ).agg(F.count("*").alias("n"))
    hit = F.when(F.col("actual") == F.col("predicted"), F.col("n")).otherwise(0)
    views = pairs.select(
        F.explode(
            F.array(
                F.struct(
                    F.col("actual").alias("k"),
                    F.col("n").alias("support"),
                    F.lit(0).cast("bigint").alias("claimed"),
                    hit.alias("hits"),
                ),
                F.struct(
                    F.col("predicted").alias("k"),
                    F.lit(0).cast("bigint").alias("support"),
                    F.col("n").alias("claimed"),
                    F.lit(0).cast("bigint").alias("hits"),
                ),
            )
        ).alias("v")
    ).select("v.*")
    classes = views.groupBy("k").agg(
        *[F.sum(name).cast("double").alias(name) for name in ("support", "claimed", "hits")]
    )
    total = F.sum("support")
    weighted = lambda score: F.sum(F.col("support") * F.coalesce(score, F.lit(0.0))) / total
    return classes.agg(
        (F.sum("hits") / total).alias("accuracy"),
        weighted(F.try_divide("hits", "claimed")).alias("weighted_precision"),
        weighted(F.try_divide("hits", "support")).alias("weighted_recall"),
        weighted(F.try_divide(2 * F.col("hits"), F.col("support") + F.col("claimed"))).alias("f1"),
    )


def preview_predictions(predictions: DataFrame, limit: int = 10) -> DataFrame:
    """The first scored rows in key order."""
    return (
        predictions.select(
            *COUNT_KEY, "error_frequency", "label", "prediction", "risk"
        )
        .orderBy(*COUNT_KEY)
        .limit(limit)
    )
