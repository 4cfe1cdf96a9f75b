"""A fitted forest (or tree) as a table of nodes, walked by built-in expressions.

``nodes`` reads a saved model's nodes: one row each, of a size given by the
model's parameters (trees x 2^(depth + 1) at most).  ``predict`` carries them as
one row beside the rows to score and walks every tree by a fold over its depth:
no vectors, no transform per tree, any Spark engine can check it row by row.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as C


@dataclass(frozen=True)
class ForestTable:
    """``trees``: one row, an array per tree of its nodes by number."""

    trees: DataFrame
    depth: int
    num_classes: int


def nodes(spark: SparkSession, path: str) -> DataFrame:
    """(tree, id, prediction, left, right, feature, threshold) of a model folder; leaves have left and right -1."""
    saved = spark.read.parquet(f"{path}/data")
    forest = "nodeData" in saved.columns
    node = "nodeData." if forest else ""
    return saved.select(
        (F.col("treeID") if forest else F.lit(0)).cast("int").alias("tree"), F.col(f"{node}id").cast("int").alias("id"),
        F.col(f"{node}prediction").alias("prediction"), F.col(f"{node}leftChild").cast("int").alias("left"),
        F.col(f"{node}rightChild").cast("int").alias("right"), F.col(f"{node}split.featureIndex").cast("int").alias("feature"),
        F.get(F.col(f"{node}split.leftCategoriesOrThreshold"), F.lit(0)).alias("threshold"))


def load(spark: SparkSession, path: str, num_classes: int = C.NUM_CLASSES, max_depth: int = C.RF_MAX_DEPTH) -> ForestTable:
    """The table of a saved model; its classes must be 0 .. num_classes - 1 and no tree deeper than ``max_depth``."""
    one = F.struct("id", "prediction", "left", "right", "feature", "threshold")
    by_tree = nodes(spark, path).groupBy("tree").agg(F.array_sort(F.collect_list(one)).alias("nodes"))
    return ForestTable(by_tree.agg(F.array_sort(F.collect_list(F.struct("tree", "nodes"))).alias("_trees")), max_depth, num_classes)


def votes(features: str = "_features", trees: str = "_trees", depth: int = C.RF_MAX_DEPTH) -> F.Column:
    """Each tree's answer; a value equal to a threshold goes left, NaN right."""
    def answer(tree):
        def step(at, _):
            node = tree["nodes"][at]
            return (F.when(node["left"] < 0, at).when(F.col(features)[node["feature"]] <= node["threshold"], node["left"])
                    .otherwise(node["right"]))

        return tree["nodes"][F.aggregate(F.sequence(F.lit(1), F.lit(depth)), F.lit(0), step)]["prediction"]

    return F.transform(F.col(trees), answer)


def majority(votes: str, num_classes: int) -> F.Column:
    """The class most trees voted for; of equally many the smallest class."""
    classes = F.array(*[F.lit(float(c)) for c in range(num_classes)])
    counted = F.transform(classes, lambda c: F.struct(F.size(F.filter(F.col(votes), lambda v: v == c)).alias("n"), (-c).alias("c")))
    return -F.array_max(counted)["c"]


def predict(model: ForestTable, rows: DataFrame) -> DataFrame:
    """``prediction`` for every row, by the trees' votes; rows without features get NO_PREDICTION."""
    has = F.lit(True)
    for c in C.FEATURE_COLUMNS:
        has = has & F.col(c).isNotNull()
    # one row of a fixed size
    given = rows.select("*", F.array(*C.FEATURE_COLUMNS).alias("_features")).crossJoin(F.broadcast(model.trees))
    voted = given.select(*rows.columns, F.when(has, votes(depth=model.depth)).alias("_votes"))
    best = majority("_votes", model.num_classes)
    # -0.0 is class 0
    return voted.select(*rows.columns, F.when(F.col("_votes").isNotNull(), best + F.lit(0.0)).otherwise(F.lit(C.NO_PREDICTION)).alias("prediction"))
