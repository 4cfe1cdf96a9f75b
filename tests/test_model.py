"""Classifiers: six classes from metadata, save/load round trip, test error range."""

import pytest

from stride import config as C
from stride.operators import model as ml
from stride.plans import registry as R
from tests.conftest import SF_CHECK


@pytest.fixture(scope="module")
def split(spark):
    train, test = R._train_test(spark, SF_CHECK)
    return train.persist(), test.persist()


def test_a_vote_is_counted_once_per_class(spark):
    """A forest's votes stay one short expression: 10 trees and 6 classes once took 42 comparisons of each vote."""
    from pyspark.sql import functions as F

    names = [f"t{i}_" for i in range(10)]
    rows = [tuple(float((i * i + r) % 6) for i in range(10)) for r in range(12)] + [tuple([5.0] * 5 + [4.0] * 5)]
    df = spark.createDataFrame(rows, ", ".join(f"{n} double" for n in names))
    best = [r[0] for r in df.select(ml.majority(names, 6)).collect()]
    assert best == [min(set(v), key=lambda c: (-v.count(c), c)) for v in rows]
    plan = df.select(F.col("*"), ml.majority(names, 6).alias("best"))._jdf.queryExecution().analyzed().expressions().mkString()
    assert 0 < plan.count("t3_") <= 7


@pytest.mark.parametrize("kind", ["rf", "dt"])
def test_six_classes_and_reload(spark, split, kind, tmp_path_factory):
    train, test = split
    assert train.select("label").distinct().count() < C.NUM_CLASSES  # no Downstairs rows
    model = ml.fit(train, kind)
    assert model.numClasses == C.NUM_CLASSES
    from stride.session import scratch_path

    path = ml.save_model(model, scratch_path(spark, f"model-{kind}"))
    again = ml.load_model(path, kind)
    a = ml.predict(model, test).select("prediction").collect()
    b = ml.predict(again, test).select("prediction").collect()
    assert a == b
    err = ml.test_error(ml.predict(model, test)).first()
    assert err.n_test == test.count() and 0.0 <= err.test_error <= 1.0


def test_split_is_deterministic(spark, split):
    train, test = split
    t2, s2 = R._train_test(spark, SF_CHECK)
    assert train.count() == t2.count() and test.count() == s2.count()
    assert train.count() > 3 * test.count()


# FIXED VALUES: the hand-typed feature vector the original kept as a smoke row
# (mean xyz, variance xyz, mean absolute deviation xyz, resultant, peak gap).
SAMPLE_VECTOR = [3.3809183673469394, -6.880102040816324, 0.8790816326530612, 50.08965378708187, 84.13105050494424,
                 20.304453787081833, 5.930491461890875, 7.544194085797583, 3.519248229904206, 12.968485972481643,
                 7.50031E8]


@pytest.mark.parametrize("kind", ["rf", "dt"])
def test_sample_vector_smoke(spark, split, kind):
    train, _ = split
    model = ml.fit(train, kind)
    row = spark.createDataFrame([tuple(SAMPLE_VECTOR)], ", ".join(f"{c} double" for c in C.FEATURE_COLUMNS))
    p = ml.predict(model, row).first().prediction
    assert p in [float(i) for i in range(C.NUM_CLASSES)]


def test_forest_counts_votes(spark):
    from pyspark.sql import functions as F

    rows = [(0.0, 0.0, 1.0), (2.0, 1.0, 1.0), (1.0, 2.0, 0.0)]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    assert [r[0] for r in df.select(ml.majority(["a", "b", "c"], 3)).collect()] == [0.0, 1.0, 0.0]  # a tie: the smallest class
    import random

    rng = random.Random(1)
    noise = [(float(rng.randrange(3)), *[rng.random() for _ in range(11)]) for _ in range(300)]
    train = spark.createDataFrame(noise, "label double, " + ", ".join(f"{c} double" for c in C.FEATURE_COLUMNS))
    model = ml.fit(train, "rf")
    single = [ml.predict(t, train).select("prediction").collect() for t in model.trees]
    for i, r in enumerate(ml.predict(model, train).select("prediction").collect()):
        votes = [s[i][0] for s in single]
        assert r[0] == min(set(votes), key=lambda v: (-votes.count(v), v))


@pytest.mark.parametrize("kind", ["rf", "dt"])
def test_nodes_table_answers_like_the_model(spark, kind):
    """Values on a threshold, NaN and missing features; many classes and deep trees."""
    import random

    from stride.operators import forest_table
    from stride.session import scratch_path

    rng = random.Random(3)
    value = lambda: rng.choice([rng.randrange(6) / 2, rng.random()])
    rows = [(float(rng.randrange(6)), *[value() for _ in range(11)]) for _ in range(800)]
    columns = ", ".join(f"{c} double" for c in C.FEATURE_COLUMNS)
    train = spark.createDataFrame(rows, "label double, " + columns)
    model = ml.fit(train, kind)
    path = ml.save_model(model, scratch_path(spark, f"nodes-{kind}"))
    table = forest_table.load(spark, path)
    assert forest_table.nodes(spark, path).count() == (model.totalNumNodes if kind == "rf" else model.numNodes)
    splits = forest_table.nodes(spark, path).where("left >= 0").limit(300).collect()
    asked = [(float("nan"), *[value() for _ in range(10)]), (None, *[1.0] * 10)] + [tuple(value() for _ in range(11)) for _ in range(200)]
    for s in splits:  # exactly on a threshold
        row = [value() for _ in range(11)]
        row[s.feature] = s.threshold
        asked.append(tuple(row))
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(asked)], "i int, " + columns)
    a, b = ({r.i: r.prediction for r in ml.predict(m, df).collect()} for m in (model, table))
    assert a == b and a[1] == C.NO_PREDICTION and len(set(a.values())) >= 6
