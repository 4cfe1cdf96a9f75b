"""State versions, commit records and the live store: bounded folders, whole batches, pruned reads."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from stride.operators import requests as rq
from stride.session import scratch_path
from stride.sources import commits, live_store, sinks
from stride.sources.tables import LIVE_SCHEMA
from stride.streaming import progress as sp

U = "00000000-0000-0000-0000-00000000000"
EVENTS = "user_id string, event_id long, ts_ns long, score double"


def events(spark, batch, users=2):
    return spark.createDataFrame([(f"{U}{u}", 10 * batch + u, 1_000_000 * (batch + 1), 0.5 * u) for u in range(users)], EVENTS)


def rows(df):
    return sorted(map(tuple, df.collect()))


def test_thousand_batches_read_a_bounded_number_of_folders(spark):
    """State versions as a service writes them, one small folder a batch; folds run as in the service."""
    import pyarrow as pa
    import pyarrow.parquet as pq

    root = scratch_path(spark, "thousand")
    sp.start_state(spark, root)
    for k in range(1000):
        folder, steps = sp.state_folders(spark, root, k)
        assert len(steps) <= 100 and all(commits._fs(spark, p)[0].exists(commits._path(spark, p)) for p in steps[-1:])
        table = pa.table({"user_id": [f"u{k % 7}"], "progress": pa.array([k % 101], pa.int64()), "psum": [float(k)],
                          "pn": pa.array([k], pa.int64()), "seen": pa.array([k], pa.int64())})
        os.makedirs(f"{root}/state/batch_id={k}")
        pq.write_table(table, f"{root}/state/batch_id={k}/part-0.parquet")
        commits.commit(spark, root, k)
        if (k + 1) % 50 == 0:
            sp.fold(spark, root, k)
    assert len(commits.names(spark, f"{root}/state")) <= 100 and len(commits.names(spark, f"{root}/folded")) <= 3
    assert len(commits.names(spark, f"{root}/commits")) <= 101 and commits.is_committed(spark, root, 3)
    got = {r.user_id: r.seen for r in sp.read_state(spark, root, 1000).collect()}
    assert got == {f"u{k % 7}": k for k in range(993, 1000)}
    # the batch before the last fold may still be done again
    assert {r.user_id: r.seen for r in sp.read_state(spark, root, 999).collect()} == {f"u{k % 7}": k for k in range(992, 999)}


def test_batch_killed_between_sinks_is_not_seen(spark, monkeypatch):
    root = scratch_path(spark, "killed")
    sp.start_state(spark, root)
    sp.step(events(spark, 0), 0, root, compact_every=2)
    before = {name: rows(sp.read_output(spark, root, name)) for name in ("states", "scores", "progress")}

    def kill(*args):
        raise RuntimeError("killed")

    with monkeypatch.context() as m:
        m.setattr(sinks, "append_published", kill)
        with pytest.raises(RuntimeError):
            sp.step(events(spark, 1), 1, root, compact_every=2)
    assert spark.read.parquet(f"{root}/scores").count() > len(before["scores"])  # the cut-off batch has written scores
    assert {name: rows(sp.read_output(spark, root, name)) for name in before} == before
    sp.step(events(spark, 1), 1, root, compact_every=2)
    again = {name: rows(sp.read_output(spark, root, name)) for name in before}
    assert len(again["states"]) == 4 and len(again["scores"]) == 4
    # a whole batch done again, also the one that was folded
    sp.step(events(spark, 1), 1, root, compact_every=2)
    sp.step(events(spark, 1), 1, root, compact_every=2)
    assert {name: rows(sp.read_output(spark, root, name)) for name in before} == again
    sp.step(events(spark, 2), 2, root, compact_every=2)
    assert [r.seen for r in sp.read_state(spark, root, 3).collect()] == [3, 3]


def test_crash_before_the_pointer_changes_nothing(spark, monkeypatch):
    root = scratch_path(spark, "pointer")
    sp.start_state(spark, root)
    for k in range(3):
        sp.step(events(spark, k), k, root, compact_every=100)
    state = rows(sp.read_state(spark, root, 3))

    def crash(*args):
        raise RuntimeError("crash")

    with monkeypatch.context() as m:
        m.setattr(commits, "put", crash)
        with pytest.raises(RuntimeError):
            sp.fold(spark, root, 2)
    assert sp.folds(spark, root) == [-1] and rows(sp.read_state(spark, root, 3)) == state
    sp.fold(spark, root, 2)
    assert sp.folds(spark, root) == [-1, 2] and sp.state_folders(spark, root, 3) == (f"{root}/folded/upto=2", [])
    assert rows(sp.read_state(spark, root, 3)) == state and rows(sp.read_state(spark, root, 2)) != state


@pytest.fixture(scope="module")
def store(spark):
    root = scratch_path(spark, "live-store")
    layout = live_store.Layout(slots=4, day_ns=100)
    data = [(f"{U}{u}", t, t, 1.0 * u, float(t % 13), 0.5) for u in range(6) for t in range(-50, 1000, 7)]
    half = len(data) // 2
    odd = [("no user", 5, 5, 1.0, 1.0, 1.0), (None, 5, 5, 1.0, 1.0, 1.0), (f"{U}1", None, 5, 1.0, 1.0, 1.0), (f"{U}1", 6, 6, None, 1.0, 1.0)]
    for k, part in enumerate((data[:half] + odd, data[half:])):
        live_store.append(spark.createDataFrame(part, LIVE_SCHEMA), root, k, layout)
    return root, layout, spark.createDataFrame(data, LIVE_SCHEMA)


def parsed(spark, bodies):
    return rq.parse_requests(spark.createDataFrame([(i, 0, b) for i, b in enumerate(bodies)], "request_id long, request_ts long, value string"))[0]


BODIES = [f"{U}1,120,140", f"{U}2,350,420", f"{U}1,130,135", f"{U}9,0,5", f"{U}3,5000,6000", f"{U}4,20,10", f"{U}1,120,140"]


def test_store_gives_the_rows_that_were_written(spark, store):
    root, _, data = store
    assert rows(live_store.readings(spark, root).select(data.columns)) == rows(data)
    zone = {(r.user_id, r._day): (r.first_ts, r.last_ts, r.n_rows) for r in live_store.zones(spark, root).collect()}
    want = {}
    for r in data.collect():
        key = (r.user_id, r.timestamp // 100)
        a, b, n = want.get(key, (r.timestamp, r.timestamp, 0))
        want[key] = (min(a, r.timestamp), max(b, r.timestamp), n + 1)
    assert zone == want


def test_repeated_and_uncommitted_batches(spark, store, monkeypatch):
    root = scratch_path(spark, "live-again")
    layout = live_store.Layout(4, 100)
    one = spark.createDataFrame([(f"{U}1", 5, 5, 1.0, 1.0, 1.0)], LIVE_SCHEMA)
    assert live_store.readings(spark, root).count() == live_store.zones(spark, root).count() == 0
    for _ in range(2):
        live_store.append(one, root, 0, layout)
    with monkeypatch.context() as m:
        m.setattr(commits, "put", lambda *a: (_ for _ in ()).throw(RuntimeError("crash")))
        with pytest.raises(RuntimeError):
            live_store.append(one, root, 1, layout)
    assert live_store.readings(spark, root).count() == 1 and live_store.zones(spark, root).first().n_rows == 1


def test_requests_from_the_store_equal_requests_from_the_table(spark, store):
    root, layout, data = store
    asked = parsed(spark, BODIES)
    want = rows(rq.request_features(asked, data, bucket_ns=10))
    assert rows(rq.request_features(asked, live_store.LiveStore(spark, root, layout), bucket_ns=10)) == want
    assert sum(r[-1] for r in want) == 4


def test_unasked_days_are_not_opened(spark):
    """Folders are pruned when the query runs, by the (day, slot) pairs of the requests: other files may hold anything."""
    root, layout = scratch_path(spark, "live-pruned"), live_store.Layout(slots=4, day_ns=100)
    data = [(f"{U}{u}", t, t, 1.0 * u, 1.0, 0.5) for u in range(6) for t in range(0, 1000, 7)]
    live_store.append(spark.createDataFrame(data, LIVE_SCHEMA), root, 0, layout)
    slot = spark.createDataFrame([(f"{U}1",)], "u string").select(live_store._slot(F.col("u"), layout)).first()[0]
    kept = spoiled = 0
    for path in glob.glob(f"{root}/readings/batch_id=0/_day=*/_slot=*/part-*.parquet"):
        if f"/_day=1/_slot={slot}/" in path:
            kept += 1
            continue
        for f in (path, os.path.join(os.path.dirname(path), f".{os.path.basename(path)}.crc")):
            if os.path.exists(f):
                os.remove(f)
        with open(path, "wb") as out:
            out.write(b"not a table")
        spoiled += 1
    assert kept == 1 and spoiled > 20
    source = live_store.LiveStore(spark, root, layout)
    spans = rq.clamped(parsed(spark, BODIES[:1]), source)
    df = source.readings(spans)
    assert "dynamicpruning" in df._jdf.queryExecution().executedPlan().toString().lower()
    # two asked days leave the days between them closed
    wide = source.readings(rq.clamped(parsed(spark, [BODIES[0], f"{U}1,101,104", f"{U}1,150,160"]), source))
    assert wide.count() == df.count()
    assert {r.timestamp for r in df.collect() if r.user_id == f"{U}1"} == set(range(105, 200, 7))
    got = rq.request_features(parsed(spark, BODIES[:1]), source, bucket_ns=10).first()
    assert got.n_rows == sum(120 <= t <= 140 for t in range(0, 1000, 7))
    with pytest.raises(Exception):
        live_store.readings(spark, root).count()
