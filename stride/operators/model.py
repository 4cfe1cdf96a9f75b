"""Activity classifiers with Spark ML (random forest and decision tree).

Labels carry nominal metadata with all six classes, so a training set that
lacks a class (the last one, say) still gives a six-class model.  The split
is a deterministic hash of the window key (no sort, no extra pass); the
original used an unseeded random split.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import (
    DecisionTreeClassificationModel,
    DecisionTreeClassifier,
    RandomForestClassificationModel,
    RandomForestClassifier,
)
from pyspark.ml.feature import VectorAssembler
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as C
from . import forest_table

FEATURES_VEC = "features"


def with_class_metadata(df: DataFrame, num_classes: int = C.NUM_CLASSES, label: str = "label") -> DataFrame:
    meta = {"ml_attr": {"type": "nominal", "name": label, "vals": [str(float(i)) for i in range(num_classes)]}}
    return df.withColumn(label, F.col(label).cast("double").alias(label, metadata=meta))


def assemble(df: DataFrame, cols: Sequence[str] = C.FEATURE_COLUMNS, out: str = FEATURES_VEC,
             handle_invalid: str = "error") -> DataFrame:
    return VectorAssembler(inputCols=list(cols), outputCol=out, handleInvalid=handle_invalid).transform(df)


def split_bucket(key_cols: Sequence[str], seed: int = 0, buckets: int = 1000) -> F.Column:
    """Deterministic bucket in [0, buckets) from the md5 of the key (repeatable in SQL)."""
    txt = F.concat_ws("|", F.lit(str(seed)), *[F.col(c).cast("string") for c in key_cols])
    return F.pmod(F.conv(F.substring(F.md5(txt), 1, 8), 16, 10).cast("bigint"), F.lit(buckets))


def split_flag(key_cols: Sequence[str], weights: tuple[float, float] = C.SPLIT_WEIGHTS, seed: int = 0,
               buckets: int = 1000) -> F.Column:
    """True for the training part: the key's bucket falls below weight * buckets."""
    return split_bucket(key_cols, seed, buckets) < F.lit(int(round(weights[0] / sum(weights) * buckets)))


def train_test(df: DataFrame, key_cols: Sequence[str], weights: tuple[float, float] = C.SPLIT_WEIGHTS,
               seed: int = 0) -> tuple[DataFrame, DataFrame]:
    f = split_flag(key_cols, weights, seed)
    return df.filter(f), df.filter(~f)


def forest(P: C.ForestParams = C.ForestParams()) -> RandomForestClassifier:
    return RandomForestClassifier(
        featuresCol=FEATURES_VEC, labelCol="label", numTrees=P.num_trees, maxDepth=P.max_depth, maxBins=P.max_bins,
        impurity=P.impurity, featureSubsetStrategy=P.feature_subset, seed=P.seed,
    )


def tree(P: C.TreeParams = C.TreeParams()) -> DecisionTreeClassifier:
    return DecisionTreeClassifier(featuresCol=FEATURES_VEC, labelCol="label", maxDepth=P.max_depth,
                                  maxBins=P.max_bins, impurity=P.impurity)


def fit(train: DataFrame, kind: str = "rf", num_classes: int = C.NUM_CLASSES):
    """Fit a six-class model on labelled feature rows (``label`` + the eleven feature columns)."""
    # tree training makes several passes (metadata, splits, one per level);
    # keep the feature rows instead of re-running the feature plan each time
    data = assemble(with_class_metadata(train, num_classes)).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        if data.isEmpty():
            raise ValueError("no labelled rows to train on")
        est = forest() if kind == "rf" else tree()
        return est.fit(data)
    finally:
        data.unpersist()


def predict(model, rows: DataFrame) -> DataFrame:
    """``prediction`` for every row, by the trees' votes; rows without features get NO_PREDICTION.

    ``model``: a fitted Spark ML model, or its table of nodes (``forest_table``).
    """
    if isinstance(model, forest_table.ForestTable):
        return forest_table.predict(model, rows)
    # one pass over the rows (a filter + union would run the feature plan
    # twice): missing features become NaN in the vector, and the model's
    # answer for those rows is replaced by NO_PREDICTION
    has = F.lit(True)
    for c in C.FEATURE_COLUMNS:
        has = has & F.col(c).isNotNull()
    scored = assemble(rows.withColumn("_has_features", has), handle_invalid="keep")
    trees = getattr(model, "trees", [model])
    votes = [f"_tree_{i}" for i in range(len(trees))]
    for tree_model, out in zip(trees, votes):
        # one prediction column per tree, nothing else
        scored = tree_model.copy({tree_model.featuresCol: FEATURES_VEC, tree_model.predictionCol: out,
                                  tree_model.rawPredictionCol: "", tree_model.probabilityCol: ""}).transform(scored)
    pred = F.when(F.col("_has_features"), majority(votes, model.numClasses)).otherwise(F.lit(C.NO_PREDICTION))
    keep = [c for c in scored.columns if c not in (FEATURES_VEC, "_has_features", *votes)]
    return scored.select(*keep, pred.alias("prediction"))


def majority(votes: Sequence[str], num_classes: int) -> F.Column:
    """The class most trees voted for (fewest others); of equally many the smallest class.

    Every class counts the votes once, over an array: compared one by one, and once
    more for the maximum, they make a generated method too long for the JVM to compile.
    """
    given = F.array(*[F.col(v) for v in votes])
    others = [F.struct(F.size(F.array_remove(given, F.lit(float(c)))).alias("others"), F.lit(float(c)).alias("class"))
              for c in range(num_classes)]
    return F.array_min(F.array(*others))["class"]


def test_error(pred: DataFrame) -> DataFrame:
    """Share of test rows whose prediction differs from the label (NULL on an empty test set)."""
    return pred.agg(
        F.count(F.lit(1)).alias("n_test"),
        F.avg((F.col("prediction") != F.col("label")).cast("double")).alias("test_error"),
    )


def save_model(model, path: str) -> str:
    model.write().overwrite().save(path)
    return path


def load_model(path: str, kind: str = "rf"):
    cls = RandomForestClassificationModel if kind == "rf" else DecisionTreeClassificationModel
    return cls.load(path)
