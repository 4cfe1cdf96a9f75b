"""Features from shared blocks against the range join and plain sums."""

import random

import pytest
from pyspark.sql import functions as F

from stride import config as C
from stride.operators import blocks as B
from stride.operators import features as feat
from stride.operators import series

HOUR = 100  # a small bucket
KEYS, GROUP = ["user_id"], ["user_id", "lo", "hi"]


def make(spark, rows):
    df = spark.createDataFrame(rows, "user_id string, ts_ns bigint, acc_x double, acc_y double, acc_z double")
    return series.local_order(df, KEYS, "ts_ns", HOUR, 0, tie_desc="acc_y").select(
        "user_id", series.BUCKET, "ts_ns", "acc_x", "acc_y", "acc_z", "first_of_ts")


def readings(rng, n=1500, span=20_000):
    times = [rng.randrange(-span // 4, span) for _ in range(n)]
    times += rng.choices(times, k=n // 10)  # repeated times
    return [(rng.choice("ab"), t, rng.uniform(-5, 5), rng.choice([rng.uniform(-20, 20), 7.0, -3.0]), rng.gauss(9.8, 0.01)) for t in times]


def spans_of(rng, n=60):
    out = {(rng.choice("abc"), *sorted((rng.randrange(-6000, 21_000), rng.randrange(-6000, 21_000)))) for _ in range(n)}
    out |= {("a", 0, 0), ("a", -6000, 21_000), ("a", 100, 199), ("a", 100, 200), ("b", 99, 1700), ("b", -400, -1), ("b", 30_000, 40_000)}
    return sorted(out)


@pytest.mark.parametrize("step,levels", [(1, 1), (1, 5), (2, 4), (3, 2)])
def test_cover_is_exact(spark, step, levels):
    rng = random.Random(levels)
    spans = spans_of(rng, 150)
    b = B.Blocks(HOUR, step, levels)
    df = spark.createDataFrame(spans, "user_id string, lo bigint, hi bigint")
    parts = {s: [] for s in spans}
    for r in B.edges(df, "lo", "hi", b).collect():
        parts[r.user_id, r.lo, r.hi].append((r._part_lo, r._part_hi))
    count = {s: 0 for s in spans}
    for r in B.cover(df, "lo", "hi", b).collect():
        wide = HOUR << (step * r._level)
        parts[r.user_id, r.lo, r.hi].append((r._block * wide, (r._block + 1) * wide - 1))
        count[r.user_id, r.lo, r.hi] += 1
    for (_, lo, hi), p in parts.items():
        p.sort()
        assert p[0][0] == lo and p[-1][1] == hi and all(x[1] + 1 == y[0] for x, y in zip(p, p[1:]))
    widest = HOUR << (step * (levels - 1))
    assert all(n <= 2 * levels * (1 << step) + (hi - lo) // widest for (_, lo, hi), n in count.items())


def same(got, want):
    assert got.keys() == want.keys() and len(got) > 30
    for k in want:
        for c in ("n_rows", "n_distinct_ts", *C.FEATURE_COLUMNS):
            assert got[k][c] == pytest.approx(want[k][c], rel=1e-9, abs=1e-9), (k, c)


@pytest.mark.parametrize("step,levels,per_task", [(2, 4, 200_000), (1, 6, 3), (1, 1, 200_000)])
def test_equals_the_range_join(spark, monkeypatch, step, levels, per_task):
    monkeypatch.setattr(B, "ASKED_PER_TASK", per_task)  # 3: crowded blocks are copied
    rng = random.Random(step)
    data = make(spark, readings(rng))
    spans = spark.createDataFrame(spans_of(rng), "user_id string, lo bigint, hi bigint")
    want = {(r.user_id, r.lo, r.hi): r for r in feat.span_features(spans, data, KEYS, GROUP, "ts_ns", "lo", "hi", True, HOUR).collect()}
    got = {(r.user_id, r.lo, r.hi): r for r in B.span_features(spans, data, KEYS, GROUP, "ts_ns", "lo", "hi", B.Blocks(HOUR, step, levels)).collect()}
    same(got, want)


def test_missing_maxima_and_nan(spark):
    """A NaN reading makes its axis' features NaN, as in the range join; constant readings have no spread."""
    rows = [("a", 10 * k, 1.5, 2.5, 0.1) for k in range(200)] + [("b", 10 * k, float("nan") if k == 77 else 1.0, float(k % 7), -1.0) for k in range(200)]
    data = make(spark, rows)
    spans = spark.createDataFrame([("a", 5, 1805), ("b", 5, 1805), ("b", 805, 1805)], "user_id string, lo bigint, hi bigint")
    got = {(r.user_id, r.lo): r for r in B.span_features(spans, data, KEYS, GROUP, "ts_ns", "lo", "hi", B.Blocks(HOUR)).collect()}
    want = {(r.user_id, r.lo): r for r in feat.span_features(spans, data, KEYS, GROUP, "ts_ns", "lo", "hi", True, HOUR).collect()}
    for k, w in want.items():
        for c in C.FEATURE_COLUMNS:
            assert got[k][c] == pytest.approx(w[c], rel=1e-9, abs=1e-9, nan_ok=True), (k, c)
    assert got["a", 5].variance_x == pytest.approx(0.0, abs=1e-12) and got["b", 5].mean_x != got["b", 5].mean_x


def test_thousand_spans_over_one_year(spark):
    """Spans that share a year: the joined rows grow with the blocks of the covers, not with spans x readings."""
    day = 24 * HOUR
    rows = [("u", HOUR * k + (k * 37) % HOUR, float(k % 11), float(k % 17) - 8, float(k % 5)) for k in range(24 * 365)]
    spans = [("u", k * 7, 365 * day - k * 5) for k in range(1000)]
    data = make(spark, rows)
    df = spark.createDataFrame(spans, "user_id string, lo bigint, hi bigint")
    b = B.Blocks(HOUR)
    assert B.cover(df, "lo", "hi", b).count() < 1000 * 160 < 1000 * 24 * 365 / 50
    got = {(r.lo, r.hi): r for r in B.span_features(df, data, KEYS, GROUP, "ts_ns", "lo", "hi", b).collect()}
    assert len(got) == 1000
    for lo, hi in [(0, 365 * day), (7 * 500, 365 * day - 2500), (7 * 999, 365 * day - 4995)]:
        inside = [r for r in rows if lo <= r[1] <= hi]
        n = len(inside)
        r = got[lo, hi]
        m = sum(x[2] for x in inside) / n
        assert r.n_rows == n and r.mean_x == pytest.approx(m)
        assert r.avg_abs_diff_x == pytest.approx(sum(abs(x[2] - m) for x in inside) / n, rel=1e-9)
        peaks = [x[1] for x in inside if int(x[3]) > 0.9 * 8]
        assert r.avg_time_peak_y == pytest.approx((peaks[-1] - peaks[0]) / (len(peaks) - 1))


def test_no_readings(spark):
    spans = spark.createDataFrame([("a", 1, 5)], "user_id string, lo bigint, hi bigint")
    empty = make(spark, [("a", 1, 0.0, 0.0, 0.0)]).where(F.lit(False))
    assert B.span_features(spans, empty, KEYS, GROUP, "ts_ns", "lo", "hi", B.Blocks(HOUR)).count() == 0
