"""Training-side plan: readings -> intervals -> windows -> features -> labelled rows.

One logical plan, no driver loop.  The readings are shuffled by
(user, activity, time bucket) twice at most: a narrow (key, ts) shuffle
shared by the three consumers of the interval scan, and the full readings
shuffle shared by both feature passes (see PLANS.md).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from .. import config as C
from ..functions.scalar import activity_label
from ..operators import features as feat
from ..operators import ranges, series
from ..sources.tables import read_counts, split_valid

TS = "ts_ns"
AXES = ("acc_x", "acc_y", "acc_z")
WINDOW_KEY = ("interval_id", "window_index", "window_lo", "window_hi")


@dataclass
class MotionPlan:
    """Lazily built DataFrames of one training run (nothing is executed here)."""

    params: C.MotionParams
    labelled: DataFrame
    rejected: DataFrame
    local: DataFrame
    series_local: DataFrame

    @property
    def keys(self) -> list[str]:
        return list(self.params.keys)

    def readings(self) -> DataFrame:
        """Bucketed readings for the range join (one shuffle, reused by both feature passes)."""
        return self.local.select(*self.keys, series.BUCKET, TS, *AXES, "first_of_ts")

    def scanned(self) -> DataFrame:
        return series.series_scan(self.series_local, self.keys, TS, self.params.gap_ns, self.params.bucket)

    def intervals(self) -> DataFrame:
        return series.intervals(self.scanned(), self.keys, TS, self.params.window_ns, self.params.min_rows)

    def windows(self) -> DataFrame:
        return ranges.end_anchored_windows(self.intervals(), self.params.window_ns, self.params.keys)

    def group_cols(self) -> list[str]:
        return [*self.keys, *WINDOW_KEY]

    def members(self) -> DataFrame:
        w = self.windows().select(*self.group_cols())
        return ranges.range_members(w, self.readings(), self.keys, TS, "window_lo", "window_hi", False,
                                    self.params.bucket)

    def moments(self) -> DataFrame:
        w = self.windows().select(*self.group_cols())
        return feat.span_moments(w, self.readings(), self.keys, self.group_cols(), TS, "window_lo", "window_hi",
                                 False, self.params.bucket)

    def second_pass(self) -> DataFrame:
        w = self.windows().select(*self.group_cols())
        return feat.span_abs_dev_and_peaks(w, self.readings(), self.keys, self.group_cols(), TS, "window_lo",
                                           "window_hi", False, self.params.bucket, self.params.peak_fraction)

    def features(self) -> DataFrame:
        w = self.windows().select(*self.group_cols())
        return feat.span_features(w, self.readings(), self.keys, self.group_cols(), TS, "window_lo", "window_hi",
                                  False, self.params.bucket, self.params.peak_fraction)

    def start_members(self) -> DataFrame:
        """Readings with their start-anchored window: one series scan of the readings, no range join."""
        scanned = series.series_scan(self.local, self.keys, TS, self.params.gap_ns, self.params.bucket)
        gated = scanned.filter(F.col("key_rows") > F.lit(self.params.min_rows))
        return ranges.start_anchored_windows(gated, TS, self.params.window_ns).select(
            *self.group_cols(), TS, *AXES, "first_of_ts")

    def start_windows(self) -> DataFrame:
        """The windows of every interval that hold a reading, counted from its start, with their readings' number."""
        return self.start_members().groupBy(*self.group_cols()).agg(F.count(F.lit(1)).alias("n_rows"))

    def start_features(self) -> DataFrame:
        return feat.member_features(self.start_members(), self.group_cols(), TS, self.params.peak_fraction)

    def labelled_features(self, anchor: str = "end", strict: bool = False) -> DataFrame:
        """Features per window with the activity's label; ``strict`` drops windows of unknown activities."""
        if anchor not in ("end", "start"):
            raise ValueError(f"anchor is 'end' or 'start', not {anchor!r}")
        f = self.features() if anchor == "end" else self.start_features()
        labelled = f.withColumn("label", activity_label("activity", strict))
        return labelled.filter(F.col("label").isNotNull()) if strict else labelled


def motion_plan(labelled: DataFrame, params: C.MotionParams | None = None, users: list | None = None,
                activities: list | None = None, counted: Observation | None = None) -> MotionPlan:
    """Validate the labelled readings and lay out the shared bucketed shuffle.

    ``counted`` receives ``n_read`` and ``n_rejected`` (readings with a missing
    column) of the pass that reads whole readings, with its first action.

    ``users`` / ``activities`` restrict the run (the original trained one user
    over six activities); the predicates reach the scan as pushed filters.
    """
    params = params or C.MotionParams()
    cols = [*params.keys, TS, *AXES]
    # readings of a series store carry their time bucket and lie by it
    stored = [series.BUCKET] if series.BUCKET in labelled.columns else []
    src = labelled.select(*cols, *stored)
    if users is not None:
        src = src.filter(F.col(params.keys[0]).isin(list(users)))
    if activities is not None:
        src = src.filter(F.col(params.keys[1]).isin(list(activities)))
    ok, bad = split_valid(src, cols)
    whole = ok if counted is None else split_valid(src.observe(counted, *read_counts(cols)), cols)[0]
    keys = list(params.keys)
    # readings for the range join: ties ordered by y (largest first) for the
    # distinct-peak count; one shuffle shared by both feature passes
    local = series.local_order(whole, keys, TS, params.bucket, params.gap_ns, tie_desc="acc_y")
    # the interval scan only needs (key, ts): a narrow shuffle shared by the
    # in-bucket scan and the bucket summaries
    series_local = series.local_order(ok.select(*keys, TS, *stored), keys, TS, params.bucket, params.gap_ns)
    return MotionPlan(params=params, labelled=ok, rejected=bad, local=local, series_local=series_local)
