"""Walking-progress closed form vs a step simulation of the three calls."""

import numpy as np
import pytest

from stride import config as C
from stride.operators import progress as prog

P = C.ProgressParams()


def simulate(p0, scores, prior=()):
    """The original sequence per moving event: raise, save, publish."""
    p, stored, out = p0, list(prior), []
    for s in scores:
        if p < P.full:
            p = P.full if p >= P.snap_from else p + P.step
        saved = p < P.full
        if saved:
            stored.append(s)
        published = P.publish_above < p <= P.full
        val = None
        if published:
            val = sum(stored) / len(stored) if stored else 0.0
            p = P.full
        out.append((p, saved, published, val))
    return out


@pytest.mark.parametrize(
    "start,after,saved,published,end",
    [(0, 2, True, False, 2), (88, 90, True, False, 90), (89, 91, True, True, 100), (90, 92, True, True, 100),
     (94, 96, True, True, 100), (95, 100, False, True, 100), (100, 100, False, True, 100),
     (101, 101, False, False, 101)],
)
def test_golden_single_event(start, after, saved, published, end):
    p, sv, pb, _ = simulate(start, [1.0])[0]
    assert (p, sv, pb) == (end, saved, published)


def test_hundred_events_from_zero():
    scores = list(np.linspace(0.1, 10.0, 100))
    out = simulate(0, scores)
    pubs = [i for i, o in enumerate(out) if o[2]]
    assert pubs[0] == 45 and len(pubs) == 55
    assert all(o[3] == pytest.approx(np.mean(scores[:46])) for o in out if o[2])


def test_closed_form_equals_simulation_everywhere(spark):
    rng = np.random.default_rng(1)
    rows, starts, sims = [], [], {}
    for p0 in range(-3, 106):
        scores = rng.normal(size=70)
        starts.append((f"u{p0}", p0))
        rows += [(f"u{p0}", i, 1000 * i, float(s)) for i, s in enumerate(scores)]
        sims[f"u{p0}"] = simulate(p0, scores)
    ev = spark.createDataFrame(rows, "user_id string, event_id long, ts_ns long, score double")
    st = spark.createDataFrame(starts, "user_id string, walking_progress int")
    for r in prog.progress_states(ev, st, None, bucket_ns=20_000).collect():
        p, sv, pb, val = sims[r.user_id][r.k - 1]
        assert (r.progress, r.saved, r.published) == (p, sv, pb), (r.user_id, r.k)
        if pb:
            assert r.published_value == pytest.approx(val)


def test_spark_closed_form_matches_simulation(spark):
    rng = np.random.default_rng(5)
    rows, starts, expected = [], [], {}
    for u, p0 in enumerate([0, 50, 88, 89, 94, 95, 100, 101]):
        scores = rng.normal(size=60)
        uid = f"user{u}"
        starts.append((uid, p0))
        for i, s in enumerate(scores):
            rows.append((uid, i, 1000 * i, float(s)))
        expected[uid] = simulate(p0, scores)
    ev = spark.createDataFrame(rows, "user_id string, event_id long, ts_ns long, score double")
    st = spark.createDataFrame(starts, "user_id string, walking_progress int")
    got = prog.progress_states(ev, st, None, bucket_ns=7000).toPandas()
    for uid, sim in expected.items():
        g = got[got.user_id == uid].sort_values("k")
        assert list(g["progress"]) == [s[0] for s in sim]
        assert list(g["saved"]) == [s[1] for s in sim]
        assert list(g["published"]) == [s[2] for s in sim]
        for v, s in zip(g["published_value"], sim):
            if s[2]:
                assert v == pytest.approx(s[3])


def test_latest_progress(spark):
    h = spark.createDataFrame([("a", 10, 1), ("a", 30, 3), ("a", 20, 2), ("b", 5, 9)],
                              "user_id string, walking_progress int, timestamp long")
    got = {r.user_id: r.walking_progress for r in prog.latest_progress(h).collect()}
    assert got == {"a": 30, "b": 5}


def test_sinks_round_trip(spark):
    from stride.session import scratch_path
    from stride.sources import sinks

    path = scratch_path(spark, "progress-sink")
    sinks.upsert_progress(spark.createDataFrame([("a", 10, 1), ("b", 4, 1)],
                                                "user_id string, walking_progress int, timestamp long"), path, 0)
    sinks.upsert_progress(spark.createDataFrame([("a", 12, 2)], "user_id string, walking_progress int, timestamp long"),
                          path, 1)
    # a retried batch 1 replaces its own folder
    sinks.upsert_progress(spark.createDataFrame([("a", 14, 2)], "user_id string, walking_progress int, timestamp long"),
                          path, 1)
    cur = {r.user_id: r.walking_progress for r in sinks.current_progress(spark, path).collect()}
    assert cur == {"a": 14, "b": 4}
    users = spark.createDataFrame([("a",), ("c",)], "user_id string")
    got = {r.user_id: r.walking_progress for r in prog.progress_for(users, sinks.current_progress(spark, path)
                                                                     .select("user_id", "walking_progress", "timestamp")).collect()}
    assert got == {"a": 14, "c": 0}
    compacted = spark.read.parquet(sinks.compact_progress(spark, path, scratch_path(spark, "progress-v2")))
    assert sorted((r.user_id, r.walking_progress) for r in compacted.collect()) == [("a", 14), ("b", 4)]


def test_upserts_leave_users_beyond_full_alone(spark):
    rows = [("a", 1, 5_000_000, 1, 2, True, False, None), ("b", 2, 7_999_999, 1, 101, False, False, None),
            ("c", 3, 9_000_000, 1, 100, False, True, 4.0)]
    st = spark.createDataFrame(rows, "user_id string, event_id long, ts_ns long, k long, progress int, saved boolean, "
                                     "published boolean, published_value double")
    got = {r.user_id: (r.walking_progress, r.timestamp) for r in prog.progress_upserts(st).collect()}
    assert got == {"a": (2, 5), "c": (100, 9)}  # milliseconds


def test_latest_progress_of_equal_times(spark):
    h = spark.createDataFrame([("a", 10, 1), ("a", 30, 1), ("a", 20, 1)], "user_id string, walking_progress int, timestamp long")
    assert prog.latest_progress(h).first().walking_progress == 30
