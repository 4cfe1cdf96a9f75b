"""The eleven motion features of a span of readings.

Two aggregation passes, both pre-aggregated map side:

1. count, distinct times, mean, sample variance (0 for one row), max per
   axis and mean resultant per span;
2. the spans with their means / max are range-joined to the readings again
   (the readings' shuffle is reused) for the mean absolute deviation and the
   peaks.

Mean time between peaks: the peaks are readings with trunc(y) > f * max(y);
the mean of the positive gaps between consecutive distinct peak times
telescopes to (last - first) / (distinct peak times - 1), so no per-span sort
is needed.  ``first_of_ts`` (from ``series.local_order`` on the readings,
largest y first among equal times) makes the distinct count exact when
timestamps repeat.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import config as C
from ..functions.scalar import java_long
from .ranges import range_members

X, Y, Z = "acc_x", "acc_y", "acc_z"


def statistics() -> dict:
    """Pass 1: name -> (aggregate, value instead of NULL)."""
    x, y, z = F.col(X), F.col(Y), F.col(Z)
    axes = (("x", x), ("y", y), ("z", z))
    return {
        "n_rows": (F.count(F.lit(1)), None),
        **{f"mean_{a}": (F.avg(c), None) for a, c in axes},
        **{f"variance_{a}": (F.var_samp(c), 0.0) for a, c in axes},
        # a NaN reading is not a maximum (it would hide every peak of the span)
        **{f"max_{a}": (F.max(F.when(~F.isnan(c), c)), None) for a, c in axes},
        "resultant": (F.avg(F.sqrt(x * x + y * y + z * z)), None),
        # distinct reading times; reading first_of_ts here also keeps both
        # passes on one readings plan, so pass 2 reuses the readings' shuffle
        "n_distinct_ts": (F.count(F.when(F.col("first_of_ts"), F.lit(1))), None),
    }


def _moments(window=None) -> list:
    """The statistics as aggregates, or as columns over a window of the group's rows."""
    out = []
    for name, (agg, default) in statistics().items():
        c = agg if window is None else agg.over(window)
        out.append((c if default is None else F.coalesce(c, F.lit(default))).alias(name))
    return out


def _second_pass(ts: str, peak_fraction: float, first: str = "first_of_ts") -> list:
    peak = java_long(F.col(Y)) > F.lit(float(peak_fraction)) * F.col("max_y")
    pts = F.when(peak, F.col(ts))
    return [
        F.avg(F.abs(F.col(X) - F.col("mean_x"))).alias("avg_abs_diff_x"),
        F.avg(F.abs(F.col(Y) - F.col("mean_y"))).alias("avg_abs_diff_y"),
        F.avg(F.abs(F.col(Z) - F.col("mean_z"))).alias("avg_abs_diff_z"),
        F.min(pts).alias("_pk_first"),
        F.max(pts).alias("_pk_last"),
        F.count(F.when(peak & F.col(first), F.lit(1))).alias("_pk_n"),
    ]


def peak_gap() -> F.Column:
    return F.when(
        F.col("_pk_n") > 1, (F.col("_pk_last") - F.col("_pk_first")) / (F.col("_pk_n") - F.lit(1)).cast("double")
    ).otherwise(F.lit(0.0))


def span_moments(spans: DataFrame, readings: DataFrame, keys: Sequence[str], group_cols: Sequence[str], ts: str,
                 lo: str, hi: str, closed: bool, bucket_ns: int) -> DataFrame:
    """Pass 1 per non-empty span (group_cols must include keys, lo and hi)."""
    m = range_members(spans, readings, keys, ts, lo, hi, closed, bucket_ns)
    return m.groupBy(*group_cols).agg(*_moments())


def span_features(spans: DataFrame, readings: DataFrame, keys: Sequence[str], group_cols: Sequence[str], ts: str,
                  lo: str, hi: str, closed: bool, bucket_ns: int,
                  peak_fraction: float = C.PEAK_FRACTION, peak: tuple[str, str] | None = None) -> DataFrame:
    """All eleven features (plus n_rows, n_distinct_ts) per non-empty span.

    ``readings``: keys, ``_bucket``, ts, acc_x, acc_y, acc_z, first_of_ts
    (output of ``series.local_order`` with the same ``bucket_ns``).  Pass 1's
    rows are the spans of pass 2 and its statistics ride along (constant per
    group), so pass 1 is computed once and no final join is needed.  ``peak``
    names the column that times peaks and the flag of its distinct values, by
    default ts and first_of_ts.
    """
    s2 = _two_passes(spans, readings, keys, group_cols, ts, lo, hi, closed, bucket_ns, peak_fraction, peak)
    return s2.select(*group_cols, "n_rows", "n_distinct_ts", *C.FEATURE_COLUMNS)


def _two_passes(spans, readings, keys, group_cols, ts, lo, hi, closed, bucket_ns, peak_fraction, peak=None) -> DataFrame:
    s1 = span_moments(spans, readings, keys, group_cols, ts, lo, hi, closed, bucket_ns)
    carry = [c for c in s1.columns if c not in group_cols]
    m2 = range_members(s1, readings, keys, ts, lo, hi, closed, bucket_ns)
    at, first = peak or (ts, "first_of_ts")
    agg = [F.any_value(c).alias(c) for c in carry] + _second_pass(at, peak_fraction, first)
    return m2.groupBy(*group_cols).agg(*agg).withColumn("avg_time_peak_y", peak_gap())


def member_features(members: DataFrame, group_cols: Sequence[str], ts: str,
                    peak_fraction: float = C.PEAK_FRACTION) -> DataFrame:
    """The features of groups given by their readings (group columns, ts, axes, first_of_ts).

    One shuffle by group: the statistics of pass 1 are window aggregates over
    the group's readings, pass 2 groups by the same columns.  For groups of a
    bounded number of readings, such as the windows of a recording.
    """
    first = members.select(*group_cols, ts, X, Y, Z, "first_of_ts", *_moments(Window.partitionBy(*group_cols)))
    agg = [F.any_value(c).alias(c) for c in statistics()] + _second_pass(ts, peak_fraction)
    return first.groupBy(*group_cols).agg(*agg).withColumn("avg_time_peak_y", peak_gap()).select(
        *group_cols, "n_rows", "n_distinct_ts", *C.FEATURE_COLUMNS)


def span_abs_dev_and_peaks(spans: DataFrame, readings: DataFrame, keys: Sequence[str], group_cols: Sequence[str],
                           ts: str, lo: str, hi: str, closed: bool, bucket_ns: int,
                           peak_fraction: float = C.PEAK_FRACTION) -> DataFrame:
    """Pass 2 output (mean absolute deviation, peak columns) per non-empty span."""
    return _two_passes(spans, readings, keys, group_cols, ts, lo, hi, closed, bucket_ns, peak_fraction)
