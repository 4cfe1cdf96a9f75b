"""Two small saved classifiers (made by this engine) and the same trees as SQL.

The registered prediction queries apply these models, so that their rows have
an independent oracle: nested CASE expressions over the features, one per tree,
and a count of votes.  ``tools/make_models.py`` makes the models anew.
"""

from __future__ import annotations

import os
from glob import glob

from pyspark.sql import SparkSession

from .. import config as C
from ..operators import model as ml
from ..session import scratch_path

FOLDER = os.path.join(os.path.dirname(os.path.abspath(__file__)), "models")


def load(spark: SparkSession, kind: str):
    """The saved model, read through the shared folder (executors do not see this package's files)."""
    shared = scratch_path(spark, f"model-{kind}")
    fs = spark._jvm.org.apache.hadoop.fs
    target = fs.Path(shared)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).copyFromLocalFile(
        False, True, fs.Path(f"file://{FOLDER}/{kind}"), target)
    return ml.load_model(shared, kind)


def _trees(kind: str) -> list[dict]:
    """Per tree: node id -> (prediction, left, right, feature, threshold)."""
    import pyarrow.parquet as pq

    trees: dict[int, dict] = {}
    for path in sorted(glob(f"{FOLDER}/{kind}/data/*.parquet")):
        for row in pq.read_table(path).to_pylist():
            node = row.get("nodeData", row)
            at = node["split"]
            trees.setdefault(row.get("treeID", 0), {})[node["id"]] = (
                node["prediction"], node["leftChild"], node["rightChild"], at["featureIndex"], at["leftCategoriesOrThreshold"])
    return [trees[k] for k in sorted(trees)]


def _tree_sql(nodes: dict, node: int = 0) -> str:
    prediction, left, right, feature, threshold = nodes[node]
    if left < 0:
        return repr(float(prediction))
    return (f"CASE WHEN {C.FEATURE_COLUMNS[feature]} <= {threshold[0]!r}::DOUBLE THEN {_tree_sql(nodes, left)} "
            f"ELSE {_tree_sql(nodes, right)} END")


def prediction_sql(kind: str, source: str) -> str:
    """``SELECT *, prediction`` of a relation with the feature columns (NULL features: no prediction)."""
    trees = _trees(kind)
    votes = ", ".join(f"CAST({_tree_sql(t)} AS DOUBLE) AS _t{i}" for i, t in enumerate(trees))
    counts = ", ".join("(" + " + ".join(f"CAST(_t{i} = {c}.0 AS INTEGER)" for i in range(len(trees))) + f") AS _n{c}"
                       for c in range(C.NUM_CLASSES))
    most = "greatest(" + ", ".join(f"_n{c}" for c in range(C.NUM_CLASSES)) + ")"
    best = " ".join(f"WHEN _n{c} = {most} THEN {c}.0" for c in range(C.NUM_CLASSES))
    missing = " OR ".join(f"{f} IS NULL" for f in C.FEATURE_COLUMNS)
    return (f"(SELECT *, CAST(CASE WHEN {missing} THEN {C.NO_PREDICTION!r} {best} END AS DOUBLE) AS prediction "
            f"FROM (SELECT *, {counts} FROM (SELECT *, {votes} FROM {source})))")
