"""Stream = batch: the streams, restarted from their checkpoint per input chunk,
reproduce their batch twins."""

from stride.plans import registry as R
from stride.plans import streams as S
from tests.conftest import SF_SMALL


def _rows(df, cols):
    return sorted(tuple(r[c] for c in cols) for r in df.select(*cols).collect())


def test_progress_stream_equals_batch(spark):
    cols = ["user_id", "event_id", "ts_ns", "k", "progress", "saved", "published", "published_value"]
    stream = R.rounded(S.q_stream_progress(spark, SF_SMALL))
    batch = R.rounded(R.q_progress_states(spark, SF_SMALL))
    assert stream.count() == batch.count() > 0
    assert _rows(stream, cols) == _rows(batch, cols)


def test_published_stream_equals_batch(spark):
    cols = ["user_id", "timestamp", "perfect_number"]
    assert _rows(R.rounded(S.q_stream_published(spark, SF_SMALL)), cols) == \
        _rows(R.rounded(R.q_published_numbers(spark, SF_SMALL)), cols)


def test_scoring_stream_dead_letters_and_rows(spark):
    cols = ["request_id", "dead_reason"]
    assert _rows(S.q_stream_dead_letters(spark, SF_SMALL), cols) == _rows(R.q_requests_dead(spark, SF_SMALL), cols)
    scored = S.q_stream_scoring(spark, SF_SMALL)
    parsed = R.q_requests_parsed(spark, SF_SMALL)
    assert scored.count() == parsed.count()
    # every request without features is answered with -1
    assert scored.filter("n_rows = 0 AND prediction <> -1.0").count() == 0


def test_progress_steps_with_prior_scores_equal_batch(spark):
    """Scores and progress stored before the stream count; batches, retries and folds change nothing."""
    import numpy as np

    from stride.operators import progress as prog
    from stride.session import scratch_path
    from stride.streaming import progress as sprog

    rng = np.random.default_rng(4)
    rows = [(f"u{u}", i, 1000 * i + u, float(s)) for u in range(4) for i, s in enumerate(rng.normal(size=60))]
    events = spark.createDataFrame(rows, "user_id string, event_id long, ts_ns long, score double")
    history = spark.createDataFrame([("u0", 0, 5), ("u1", 88, 5), ("u2", 93, 5), ("u2", 3, 4)],
                                    "user_id string, walking_progress int, timestamp long")
    prior = spark.createDataFrame([("u0", 1, 10.0), ("u0", 2, 20.0), ("u3", 1, -5.0)],
                                  "user_id string, timestamp long, perfect_number double")
    batch = prog.progress_states(events, prog.latest_progress(history), prior)
    root = scratch_path(spark, "steps")
    sprog.start_state(spark, root, history, prior)
    for n in (0, 1, 1, 2, 3, 2, 3):  # batches 1, 2 and 3 are done twice, as after a crash
        sprog.step(events.filter(f"event_id div 15 = {n}"), n, root, compact_every=2)
        sprog.start_state(spark, root, history, prior)  # a restart leaves the state alone
    got = spark.read.parquet(f"{root}/states").drop("batch_id")
    cols = ["user_id", "event_id", "k", "progress", "saved", "published", "published_value"]
    clean = lambda df: sorted(tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in df.select(*cols).collect())
    assert clean(got) == clean(batch) and got.count() == 240
    assert spark.read.parquet(f"{root}/scores").count() == batch.filter("saved").count()


def test_a_batch_is_parsed_once(spark):
    """Time span, asked spans, results and dead letters read the parsed fields, not the messages again."""
    from pyspark.sql import functions as F

    from stride.plans import saved_models
    from stride.session import scratch_path
    from stride.streaming import scoring

    user = "00000000-0000-0000-0000-000000000001"
    bodies = [f"{user},0,9", f"{user},5,3", "", f"{user},x,9", "not-a-uuid,0,9", "0-0-0-0-1,0,9"]
    reads = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def read(body):
        reads.add(1)
        return body

    live = spark.createDataFrame([(user, t, t, float(t), 9.0, -1.0) for t in range(20)],
                                 "user_id string, timestamp long, timestamp_long long, x double, y double, z double")
    msgs = spark.createDataFrame([(i, 0, b) for i, b in enumerate(bodies)], "request_id long, request_ts long, value string")
    out = scratch_path(spark, "parsed-once")
    scoring.score_step(msgs.withColumn("value", read("value")), 0, lambda: live, saved_models.load(spark, "rf"), out)
    results = {r.request_id: r for r in spark.read.parquet(f"{out}/results").collect()}
    assert {i: r.n_rows for i, r in results.items()} == {0: 10, 1: 0, 4: 0, 5: 10}
    assert results[5].user_id == user and results[5].prediction == results[0].prediction != -1.0 == results[4].prediction
    dead = {(r.request_id, r.value, r.dead_reason) for r in spark.read.parquet(f"{out}/dead").collect()}
    assert dead == {(2, "", "empty"), (3, f"{user},x,9", "bad_number")}
    assert reads.value == len(bodies)


def test_the_scoring_stream_stores_its_live_table_once(spark):
    """Batches read the stored table, not the fixture's mapping of every event, batch after batch."""
    root = S.run_scoring_stream(spark, SF_SMALL).rsplit("/", 1)[0]
    cols = ["user_id", "timestamp", "timestamp_long", "x", "y", "z"]
    assert _rows(spark.read.parquet(f"{root}/live"), cols) == _rows(S.fx.live(S.fx.events(spark, SF_SMALL)), cols)
