"""The training job and the live service itself."""

import pytest
from pyspark.sql import functions as F

from stride.operators import model as ml
from stride.operators import progress as prog
from stride.plans import jobs
from stride.plans import registry as R
from stride.session import checkpoint_root, materialize, scratch_path
from stride.sources import fixtures as fx
from stride.sources import tables
from stride.sources.tables import LIVE_SCHEMA, REQUEST_SCHEMA
from stride.streaming import scoring as sscore
from tests.conftest import SF_SMALL

U = "00000000-0000-0000-0000-000000000001"


@pytest.fixture(scope="module")
def model_path(spark):
    """A small tree model whose answer is always class 0 or 1 (moving)."""
    rows = [(float(i % 2), *[float(i % 2)] * 11) for i in range(40)]
    train = spark.createDataFrame(rows, "label double, " + ", ".join(f"{c} double" for c in ml.C.FEATURE_COLUMNS))
    return ml.save_model(ml.fit(train, "dt"), scratch_path(spark, "small-model"))


class Service:
    """serve() on new folders; run() handles what has arrived."""

    def __init__(self, spark, model_path, history=None, scores=None):
        self.spark, self.model, self.history, self.scores = spark, model_path, history, scores
        self.root = scratch_path(spark, "service")
        spark.createDataFrame([], LIVE_SCHEMA).write.parquet(f"{self.root}/live")
        spark.createDataFrame([], REQUEST_SCHEMA).write.parquet(f"{self.root}/in")

    def readings(self, rows):
        self.spark.createDataFrame([(u, t, t, 1.0, 1.0, 1.0) for u, t in rows], LIVE_SCHEMA).write.mode("append").parquet(f"{self.root}/live")

    def ask(self, *rows):
        self.spark.createDataFrame(list(rows), REQUEST_SCHEMA).coalesce(1).write.mode("append").parquet(f"{self.root}/in")

    def run(self):
        stream = tables.read_requests_stream(self.spark, f"{self.root}/in")
        q = jobs.serve(self.spark, stream, lambda: tables.read_live(self.spark, f"{self.root}/live"), self.model, f"{self.root}/out",
                       f"{self.root}/chk", self.history, "dt", self.scores, trigger={"availableNow": True}, compact_every=2)
        q.awaitTermination()
        assert q.exception() is None

    def read(self, name):
        return self.spark.read.parquet(f"{self.root}/out/{name}")


def test_readings_that_arrive_between_batches_are_found(spark, model_path):
    s = Service(spark, model_path)
    s.ask((1, 10_000_000, f"{U},0,100"))
    s.run()
    s.readings([(U.upper(), t) for t in range(6)])  # the stored identifier may be written in upper case
    s.ask((2, 20_000_000, f"{U},0,100"))
    s.run()
    got = {r.request_id: (r.n_rows, r.prediction) for r in s.read("results").collect()}
    assert got[1] == (0, -1.0) and got[2][0] == 6 and got[2][1] >= 0
    assert [(r.event_id, r.k) for r in s.read("progress/states").collect()] == [(2, 1)]


def test_restart_goes_on_and_a_repeated_batch_changes_nothing(spark, model_path):
    history = spark.createDataFrame([(U, 88, 1)], "user_id string, walking_progress int, timestamp long")
    scores = spark.createDataFrame([(U, 1, 7.0)], "user_id string, timestamp long, perfect_number double")
    s = Service(spark, model_path, history, scores)
    s.readings([(U, t) for t in range(5)])
    for n in range(3):  # three runs of the service
        s.ask((n, (n + 1) * 1_000_000, f"{U},0,9"))
        s.run()
    before = sorted(map(tuple, s.read("progress/states").collect()))
    assert [(r[1], r[3], r[5]) for r in sorted(before, key=lambda r: r[3])] == [(0, 1, 90), (1, 2, 100), (2, 3, 100)]
    # the last batch is cut off before its commit and done again
    model = ml.load_model(s.model, "dt")
    again = sscore.service_writer(lambda: tables.read_live(spark, f"{s.root}/live"), model, f"{s.root}/out")
    last = max(r.batch_id for r in s.read("results").select("batch_id").collect())
    again(spark.createDataFrame([(2, 3_000_000, f"{U},0,9")], REQUEST_SCHEMA), last)
    assert sorted(map(tuple, s.read("progress/states").collect())) == before
    current = prog.latest_progress(s.read("progress/progress")).first()
    assert (current.walking_progress, current.timestamp) == (100, 3)  # milliseconds, as stored


def test_no_message_stops_the_service(spark, model_path):
    s = Service(spark, model_path)
    s.readings([(U, t) for t in range(5)])
    low, high = -(1 << 63), (1 << 63) - 1
    s.ask((1, 1, f"{U},{low},{high}"), (2, 2, f"{U},{low},3"), (3, 3, f"{U},1,{high}"), (4, 4, "\ufffd\ufffd"), (5, 5, f"{U},5\n,6"), (6, 6, None))
    s.run()
    got = {r.request_id: r.n_rows for r in s.read("results").collect()}
    assert got == {1: 5, 2: 4, 3: 4}
    assert {r.request_id for r in s.read("dead").collect()} == {4, 5, 6}


def test_repeated_request_ids_do_not_multiply(spark, model_path):
    s = Service(spark, model_path)
    s.readings([(U, t) for t in range(5)])
    s.ask((1, 1, f"{U},0,9"), (1, 1, f"{U},0,9"), (1, 2, f"{U},0,2"))
    s.run()
    assert sorted(r.n_rows for r in s.read("results").collect()) == [3, 5, 5]


def test_checkpoint_folder_is_needed_on_a_cluster(spark):
    class Context:
        master = "yarn"

        def getConf(self):
            return self

        def get(self, key, default=None):
            return default

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext, conf = Context(), Context()

    with pytest.raises(ValueError):
        checkpoint_root(Session())


def test_train_then_serve(spark):
    ev = fx.events(spark, SF_SMALL)
    model_path = scratch_path(spark, "job-model")
    missing = fx.labelled(ev).limit(3).withColumn("acc_y", F.lit(None).cast("double"))  # three readings without y
    rejected = scratch_path(spark, "job-rejected")
    r = jobs.train(fx.labelled(ev).unionByName(missing), model_path, "rf", params=R.FIXTURE_PARAMS, rejected_path=rejected)
    assert r.sample_size == 192 and r.rejected == spark.read.parquet(rejected).count() == 3
    err = r.test_error.first()
    assert err.n_test > 0 and 0.0 <= err.test_error <= 1.0

    root = scratch_path(spark, "job-serve")
    materialize(fx.requests(ev), "job-messages").write.parquet(f"{root}/in")
    stream = spark.readStream.schema(REQUEST_SCHEMA).parquet(f"{root}/in")
    history = fx.progress_history(ev)
    q = jobs.serve(spark, stream, lambda: fx.live(fx.events(spark, SF_SMALL)), model_path, f"{root}/out", f"{root}/chk",
                   history, trigger={"availableNow": True})
    q.awaitTermination()

    results = spark.read.parquet(f"{root}/out/results").drop("batch_id")
    assert results.count() == R.q_requests_parsed(spark, SF_SMALL).count()
    states = spark.read.parquet(f"{root}/out/progress/states").drop("batch_id")
    batch = prog.progress_states(sscore.moving_events(results), prog.latest_progress(history), None)
    cols = ["user_id", "event_id", "k", "progress", "saved", "published"]
    got = sorted(tuple(x[c] for c in cols) for x in states.select(*cols).collect())
    exp = sorted(tuple(x[c] for c in cols) for x in batch.select(*cols).collect())
    assert got == exp and len(got) == results.filter("prediction IN (0.0, 1.0, 5.0)").count()
