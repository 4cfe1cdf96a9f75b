"""End-anchored windows and the eleven features (golden rows from FIXTURES.md)."""

import numpy as np
import pandas as pd
import pytest

from stride import config as C
from stride.operators import ranges, series
from stride.operators import features as feat
from stride.functions.scalar import java_long

MS = 1_000_000
S = 1_000_000_000


def test_end_anchored_windows(spark):
    iv = spark.createDataFrame([("u", "Walking", 0, 0, 12 * S, 2)],
                               "user_id string, activity string, interval_id long, interval_start long, "
                               "interval_end long, n_windows long")
    w = ranges.end_anchored_windows(iv, 5 * S).orderBy("window_index").collect()
    assert [(r.window_lo // S, r.window_hi // S) for r in w] == [(7, 12), (12, 17), (17, 22)]


def test_window_membership_is_open(spark):
    # readings at 0..7 s and exactly at 12 s fall in no window of the 0-12 s interval
    rows = [("u", "Walking", t * S, 0.0, 1.0, 0.0) for t in (0, 3, 7, 8, 12, 13, 21)]
    df = spark.createDataFrame(rows, "user_id string, activity string, ts_ns long, acc_x double, acc_y double, acc_z double")
    iv = spark.createDataFrame([("u", "Walking", 0, 0, 12 * S, 2)],
                               "user_id string, activity string, interval_id long, interval_start long, "
                               "interval_end long, n_windows long")
    w = ranges.end_anchored_windows(iv, 5 * S).select("user_id", "activity", "interval_id", "window_index",
                                                      "window_lo", "window_hi")
    rd = series.local_order(df, ["user_id", "activity"], "ts_ns", 5 * S, 1, tie_desc="acc_y")
    m = ranges.range_members(w, rd, ["user_id", "activity"], "ts_ns", "window_lo", "window_hi", False, 5 * S)
    got = sorted((r.window_index, r.ts_ns // S) for r in m.collect())
    assert got == [(0, 8), (1, 13), (2, 21)]


GOLDEN = [
    ([(0, 0, 9.8, 0), (50, 3, 1.2, 4), (100, 0, 9.6, 0), (150, 3, 0.3, 4), (200, 0, 9.9, 0)],
     [1.2, 6.16, 1.6, 2.7, 24.503, 4.8, 1.44, 4.328, 1.92, 7.890195193484051, 1e8]),
    ([(0, 0, 1.5, 0), (50, 0, 1.4, 0), (100, 0, 1.5, 0)],
     [0, 1.4666666666666668, 0, 0, 0.0033333333333333, 0, 0, 0.0444444444444444, 0, 1.4666666666666668, 0]),
    ([(0, 0, -2, 0), (50, 0, -3, 0)], [0, -2.5, 0, 0, 0.5, 0, 0, 0.5, 0, 2.5, 0]),
    ([(0, 0, -0.5, 0), (50, 0, -0.6, 0), (100, 0, -3, 0)],
     [0, -1.3666666666666667, 0, 0, 2.0033333333333334, 0, 0, 1.0888888888888888, 0, 1.3666666666666667, 5e7]),
    ([(0, 1, 2, 2)], [1, 2, 2, 0, 0, 0, 0, 0, 0, 3, 0]),
]


@pytest.mark.parametrize("rows,expected", GOLDEN)
def test_feature_golden_rows(spark, rows, expected):
    data = [("u", "Walking", t * MS, float(x), float(y), float(z)) for t, x, y, z in rows]
    df = spark.createDataFrame(data, "user_id string, activity string, ts_ns long, acc_x double, acc_y double, acc_z double")
    spans = spark.createDataFrame([("u", "Walking", 1, -1, 10**9)],
                                  "user_id string, activity string, span long, lo long, hi long")
    rd = series.local_order(df, ["user_id", "activity"], "ts_ns", 10**9, 1, tie_desc="acc_y")
    rd = rd.select("user_id", "activity", series.BUCKET, "ts_ns", "acc_x", "acc_y", "acc_z", "first_of_ts")
    f = feat.span_features(spans, rd, ["user_id", "activity"], ["user_id", "activity", "span", "lo", "hi"],
                           "ts_ns", "lo", "hi", False, 10**9).first()
    got = [f[c] for c in C.FEATURE_COLUMNS]
    assert got == pytest.approx(expected, rel=1e-9, abs=1e-9)
    assert f.n_rows == len(rows)


def test_duplicate_timestamps_peak_gap(spark):
    # peaks at 0, 100, 100 (duplicate), 200: positive gaps 100, 100 -> mean 1e8 ns
    rows = [(0, 9.9), (100, 9.5), (100, 1.0), (200, 9.8), (150, 0.0)]
    data = [("u", "Walking", t * MS, 0.0, y, 0.0) for t, y in rows]
    df = spark.createDataFrame(data, "user_id string, activity string, ts_ns long, acc_x double, acc_y double, acc_z double")
    spans = spark.createDataFrame([("u", "Walking", 1, -1, 10**9)],
                                  "user_id string, activity string, span long, lo long, hi long")
    rd = series.local_order(df, ["user_id", "activity"], "ts_ns", 10**9, 1, tie_desc="acc_y")
    f = feat.span_features(spans, rd, ["user_id", "activity"], ["user_id", "activity", "span", "lo", "hi"],
                           "ts_ns", "lo", "hi", False, 10**9).first()
    assert f.avg_time_peak_y == pytest.approx(1e8)
    assert f.n_distinct_ts == 4


def test_java_long_cast(spark):
    df = spark.createDataFrame([(1.7,), (-1.7,), (-0.5,), (float("nan"),), (float("inf"),), (float("-inf"),), (None,)], "y double")
    got = [r[0] for r in df.select(java_long("y")).collect()]
    assert got == [1, -1, 0, 0, C.LONG_MAX, C.LONG_MIN, None]


def test_user_activity_selection_is_pushed_to_scan(spark, tmp_path_factory):
    from stride.plans.motion import motion_plan
    from stride.session import scratch_path
    from stride.sources.tables import read_labelled

    path = scratch_path(spark, "labelled")
    rows = [(u, a, t * 50 * MS, 0.0, 1.0, 0.0) for u in (17, 20, 33) for a in ("Walking", "Jogging") for t in range(120)]
    spark.createDataFrame(rows, "user_id long, activity string, ts_ns long, acc_x double, acc_y double, "
                                "acc_z double").write.parquet(path)
    p = motion_plan(read_labelled(spark, path), C.MotionParams(), users=[33], activities=list(C.ACTIVITIES))
    spark.conf.set("spark.sql.debug.maxToStringFields", "1000")
    plan = p.intervals()._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(user_id,33)" in plan and "In(activity, [Downstairs" in plan
    got = p.intervals().collect()
    assert {r.user_id for r in got} == {33} and len(got) == 2


def test_long_interval_windows_are_generated_exactly(spark):
    # 3 * CHUNK + 5 windows: several chunks, spread over tasks, nothing lost
    n = 3 * ranges.CHUNK + 5
    iv = spark.createDataFrame([("u", "Walking", 7, 0, n * S, n)],
                               "user_id string, activity string, interval_id long, interval_start long, "
                               "interval_end long, n_windows long")
    w = ranges.end_anchored_windows(iv, S)
    got = w.agg({"window_index": "count"}).first()[0]
    assert got == n + 1
    assert w.select("window_index").distinct().count() == n + 1


def _brute_features(g: pd.DataFrame) -> list[float]:
    x, y, z, t = g.acc_x.to_numpy(), g.acc_y.to_numpy(), g.acc_z.to_numpy(), g.ts_ns.to_numpy()
    n = len(g)
    var = (lambda a: float(np.var(a, ddof=1)) if n > 1 else 0.0)
    peaks = np.sort(t[np.trunc(y) > 0.9 * y.max()])
    d = np.diff(peaks)
    d = d[d > 0]
    gap = float(d.mean()) if len(d) else 0.0
    return [x.mean(), y.mean(), z.mean(), var(x), var(y), var(z), np.abs(x - x.mean()).mean(),
            np.abs(y - y.mean()).mean(), np.abs(z - z.mean()).mean(), np.sqrt(x * x + y * y + z * z).mean(), gap]


def test_features_equal_brute_force_with_repeated_times(spark):
    rng = np.random.default_rng(11)
    n = 4000
    pdf = pd.DataFrame({
        "user_id": rng.choice(["a", "b"], n), "activity": "Walking",
        "ts_ns": rng.integers(0, 2000, n) * 5,  # many repeated timestamps
        "acc_x": rng.normal(size=n).round(3), "acc_y": rng.normal(3, 4, n).round(2), "acc_z": rng.normal(size=n),
    })
    spans = pd.DataFrame({"user_id": rng.choice(["a", "b"], 60), "activity": "Walking",
                          "span": np.arange(60), "lo": rng.integers(-10, 9000, 60)})
    spans["hi"] = spans.lo + rng.choice([7, 60, 400], 60)
    rd = series.local_order(spark.createDataFrame(pdf), ["user_id", "activity"], "ts_ns", 100, 1, tie_desc="acc_y")
    got = feat.span_features(spark.createDataFrame(spans), rd, ["user_id", "activity"],
                             ["user_id", "activity", "span", "lo", "hi"], "ts_ns", "lo", "hi", False, 100).toPandas()
    got = got.set_index("span")
    checked = 0
    for s in spans.itertuples():
        g = pdf[(pdf.user_id == s.user_id) & (pdf.ts_ns > s.lo) & (pdf.ts_ns < s.hi)]
        if g.empty:
            assert s.span not in got.index
            continue
        row = got.loc[s.span]
        assert row.n_rows == len(g) and row.n_distinct_ts == g.ts_ns.nunique()
        assert [row[c] for c in C.FEATURE_COLUMNS] == pytest.approx(_brute_features(g), rel=1e-9, abs=1e-9)
        checked += 1
    assert checked > 40
