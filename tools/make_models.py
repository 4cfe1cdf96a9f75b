"""Make the saved classifiers of ``stride/plans/models`` anew: make_models.py SF_DIR OUT_DIR [MORE_SF_DIRS].

The training features are moved by a small offset whose digits never end, and
seeds are tried until no split value lies within rounding distance of a feature
value of the tables, so that other engines give the same answers.
"""

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import numpy as np  # noqa: E402

from stride import config as C  # noqa: E402
from stride.operators import model as ml  # noqa: E402
from stride.plans import registry  # noqa: E402
from stride.session import local_session, materialize  # noqa: E402

OFFSET = 3.1415926535897932e-05
SPLIT = re.compile(r"If \(feature (\d+) <= ([-0-9.E]+)\)")


def clear_of(model, values) -> bool:
    splits = [(int(f), float(x)) for f, x in SPLIT.findall(model.toDebugString)]
    return all(np.abs(values[:, f] - x).min() > 1e-9 * max(1.0, abs(x)) for f, x in splits)


if __name__ == "__main__":
    sf_dir, out, *more = sys.argv[1:]
    spark = local_session(4, 4)
    found = []
    for d in (sf_dir, *more):
        rows = materialize(registry._plan(spark, d).labelled_features(), "model-rows")
        parsed, _ = registry._requests(spark, d)
        asked = registry.rq.request_features(parsed, registry.fx.live(registry._ev(spark, d)))
        # a few ten thousand rows
        found += [df.select(*C.FEATURE_COLUMNS).dropna().distinct().toPandas().to_numpy() for df in (rows, asked)]
    values = np.concatenate(found)
    rows = materialize(registry._plan(spark, sf_dir).labelled_features(), "model-rows")
    train, _ = ml.train_test(rows, registry.SPLIT_KEY)
    moved = train.withColumns({c: train[c] + OFFSET for c in C.FEATURE_COLUMNS})
    data = ml.assemble(ml.with_class_metadata(moved)).coalesce(1).persist()
    # the original's size and seed; other seeds, then smaller depths, only where a split lies on a value
    for seed in (C.RF_SEED, *range(1, 60)):
        forest = ml.forest(C.ForestParams(seed=seed)).fit(data)
        if clear_of(forest, values):
            ml.save_model(forest, f"{out}/rf")
            print("forest seed", seed, "nodes", forest.totalNumNodes)
            break
    for depth in range(C.DT_MAX_DEPTH, 0, -1):
        tree = ml.tree(C.TreeParams(max_depth=depth)).fit(data)
        if clear_of(tree, values):
            ml.save_model(tree, f"{out}/dt")
            print("tree depth", depth, "nodes", tree.numNodes)
            break
