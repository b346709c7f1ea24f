"""A fitted forest as plain column expressions and as SQL.

The trees are read from the model's stored node table, whose rows are bounded by the number of trees
and their depth. Each becomes one nested condition that gives the class shares of a row's leaf;
they are added up tree by tree, in the order and with the operations of the model itself, so risks are
equal to the last bit. Scoring then needs no vectors and no model on the way: it can be
pushed around by the optimizer, run as SQL elsewhere, and be read.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce
from operator import add

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logrisk.operators.risk_model import MODEL_INPUTS, is_complete
from logrisk.sources.scratch import scratch_path


@dataclass(frozen=True)
class Leaf:
    """The shares of label 0 and 1 among the training rows of a leaf."""

    shares: tuple[float, float]


@dataclass(frozen=True)
class Split:
    """Rows go to ``low`` where the input is at most ``threshold``, or one of ``categories``."""

    name: str
    threshold: float | None
    categories: tuple[float, ...]
    low: Split | Leaf
    high: Split | Leaf


@dataclass(frozen=True)
class Forest:
    """Trees in order, and the sources by their index; any other source comes after them."""

    sources: tuple[str, ...]
    trees: tuple[Split | Leaf, ...]


def read_forest(spark: SparkSession, path: str) -> Forest:
    """The forest of a stored risk model."""
    labels = PipelineModel.load(path).stages[0].labels
    nodes = spark.read.parquet(f"{path}/stages/*RandomForestClassifier*/data").select("treeID", "nodeData.*")
    trees: dict[int, dict] = {}
    for node in nodes.collect():  # at most trees times 2 ** (depth + 1) rows
        trees.setdefault(node.treeID, {})[node.id] = node

    def build(tree: dict, place: int) -> Split | Leaf:
        node = tree[place]
        if node.leftChild < 0:
            total = sum(node.impurityStats)
            return Leaf(tuple(count / total for count in node.impurityStats))
        told, kinds = tuple(node.split.leftCategoriesOrThreshold), node.split.numCategories
        return Split(
            MODEL_INPUTS[node.split.featureIndex],
            told[0] if kinds < 0 else None,
            told if kinds >= 0 else (),
            build(tree, node.leftChild),
            build(tree, node.rightChild),
        )

    return Forest(tuple(labels), tuple(build(trees[number], 0) for number in sorted(trees)))


def forest_of(model: PipelineModel) -> Forest:
    """The forest of a fitted risk model."""
    spark = SparkSession.active()
    path = scratch_path(spark, "forest")
    model.write().overwrite().save(path)
    return read_forest(spark, path)


def _folded(tree: Split | Leaf, leaf: Callable, split: Callable):
    if isinstance(tree, Leaf):
        return leaf(tree)
    return split(tree, _folded(tree.low, leaf, split), _folded(tree.high, leaf, split))


def source_index(forest: Forest) -> Column:
    """The index of ``source`` that the forest was trained with."""
    index = F.lit(float(len(forest.sources)))
    for place, source in reversed(list(enumerate(forest.sources))):
        index = F.when(F.col("source") == source, float(place)).otherwise(index)
    return index


def score_by_columns(forest: Forest, features: DataFrame) -> DataFrame:
    """Add ``prediction`` and ``risk`` as ``score_risk`` does, by built-in expressions only.

    All rows are kept; those with an unknown input have no score.
    """

    def leaf(node: Leaf) -> Column:
        return F.struct(*[F.lit(share).alias(f"c{label}") for label, share in enumerate(node.shares)])

    def split(node: Split, low: Column, high: Column) -> Column:
        value = F.col(f"in_{node.name}")
        is_low = value.isin(*node.categories) if node.threshold is None else value <= node.threshold
        return F.when(is_low, low).otherwise(high)

    given = {f"in_{name}": F.col(name).cast("double") for name in MODEL_INPUTS if name != "source_index"}
    given["in_source_index"] = source_index(forest)
    leaves = [_folded(tree, leaf, split) for tree in forest.trees]
    votes = features.withColumns(given).select(
        *[features[name] for name in features.columns],
        F.when(is_complete(), F.array(*leaves)).alias("_leaves"),
    )

    def added(share: str) -> Column:
        return F.aggregate("_leaves", F.lit(0.0), lambda so_far, shares: so_far + shares[share])

    voted = votes.withColumns({"_against": added("c0"), "_for": added("c1")})
    against, in_favour = F.col("_against"), F.col("_for")
    return voted.withColumns(
        {
            "prediction": F.when(in_favour > against, 1.0).when(against.isNotNull(), 0.0),
            "risk": in_favour / (against + in_favour),
        }
    ).drop("_leaves", "_against", "_for")


def _number(value: float) -> str:
    return f"{value:.17e}"


def forest_sql(forest: Forest, table: str) -> str:
    """A query that adds ``prediction`` and ``risk`` to ``table``, for engines without the model."""

    def split(node: Split, low: str, high: str) -> str:
        if node.threshold is None:
            listed = ", ".join(map(_number, node.categories))
            told = f"{node.name} IN ({listed})"
        else:
            told = f"{node.name} <= {_number(node.threshold)}"
        return f"CASE WHEN {told} THEN {low} ELSE {high} END"

    quoted = lambda text: "'" + text.replace("'", "''") + "'"
    sources = " ".join(f"WHEN {quoted(source)} THEN {_number(place)}" for place, source in enumerate(forest.sources))
    last = _number(len(forest.sources))
    index = f"CASE source {sources} ELSE {last} END" if sources else last
    votes = [
        reduce(add, [f"\n    + {_folded(tree, lambda node, i=label: _number(node.shares[i]), split)}" for tree in forest.trees])
        for label in (0, 1)
    ]
    known = " AND ".join(f"{name} IS NOT NULL" for name in MODEL_INPUTS if name != "source_index")
    return f"""WITH indexed AS (SELECT *, {index} AS source_index FROM {table}),
voted AS (
  SELECT *, CASE WHEN {known} THEN {_number(0)}{votes[0]} END AS votes_against,
    CASE WHEN {known} THEN {_number(0)}{votes[1]} END AS votes_for
  FROM indexed
)
SELECT * EXCLUDE (source_index, votes_against, votes_for),
  CASE WHEN votes_for > votes_against THEN {_number(1)} WHEN votes_against IS NOT NULL THEN {_number(0)} END AS prediction,
  votes_for / (votes_against + votes_for) AS risk
FROM voted"""
