"""Parameters of the motion pipeline.

Every semantic constant is a parameter; the defaults are the values the
original application hard-codes.  They are collected here, in plain text, so
that the rest of the package never repeats a literal.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# ---------------------------------------------------------------------------
# FIXED VALUES -- these must equal the original application's values for the
# results to match.  Do not change them to make a test pass.
# ---------------------------------------------------------------------------

# Activities in the order the training job visits them.
ACTIVITIES = ("Standing", "Jogging", "Walking", "Sitting", "Upstairs", "Downstairs")

# Activity name -> class label.  Any other name gets DEFAULT_LABEL.
ACTIVITY_LABELS = {
    "Walking": 0.0,
    "Jogging": 1.0,
    "Standing": 2.0,
    "Sitting": 3.0,
    "Upstairs": 4.0,
    "Downstairs": 5.0,
}
DEFAULT_LABEL = 0.0
NUM_CLASSES = 6

# A (user, activity) series is used only when it has MORE than this many rows.
MIN_GROUP_ROWS = 100
# Two consecutive readings more than this apart (ns) start a new recording interval.
GAP_NS = 100_000_000
# Window length and step (ns).
WINDOW_NS = 5_000_000_000
# A reading is a peak when trunc(y) is strictly greater than this fraction of max(y).
PEAK_FRACTION = 0.9

# Train / test split weights.
SPLIT_WEIGHTS = (0.8, 0.2)

# Random forest: 10 trees, gini, depth 9, 32 bins, "auto" feature subsets, seed 12345.
RF_NUM_TREES = 10
RF_MAX_DEPTH = 9
RF_MAX_BINS = 32
RF_IMPURITY = "gini"
RF_FEATURE_SUBSET = "auto"
RF_SEED = 12345
# Decision tree: gini, depth 9, 32 bins.
DT_MAX_DEPTH = 9
DT_MAX_BINS = 32
DT_IMPURITY = "gini"

# Predictions that count as "moving" for the walking-progress state.
MOVING_LABELS = (0.0, 1.0, 5.0)
# Progress: +2 per moving event while below 100; 95 or more snaps to 100.
PROGRESS_STEP = 2
PROGRESS_SNAP_FROM = 95
PROGRESS_FULL = 100
# Publication happens while PUBLISH_ABOVE < progress <= PROGRESS_FULL.
PUBLISH_ABOVE = 90
# The per-event score is the sum of the feature vector divided by this fixed number.
SCORE_DIVISOR = 11.0
# Prediction reported when a request cannot be scored.
NO_PREDICTION = -1.0

# Request message: comma separated "user,start,finish[,ignored...]".
REQUEST_SEPARATOR = ","
# Identifier check (five hex groups) and integer check for the two times.
UUID_PATTERN = r"^[0-9a-fA-F]{1,8}(-[0-9a-fA-F]{1,12}){4}\z"
LONG_PATTERN = r"^[+-]?[0-9]+\z"

# Names of the eleven features, in model order.
FEATURE_COLUMNS = (
    "mean_x",
    "mean_y",
    "mean_z",
    "variance_x",
    "variance_y",
    "variance_z",
    "avg_abs_diff_x",
    "avg_abs_diff_y",
    "avg_abs_diff_z",
    "resultant",
    "avg_time_peak_y",
)

LONG_MAX = 9_223_372_036_854_775_807
LONG_MIN = -9_223_372_036_854_775_808


@dataclass(frozen=True)
class MotionParams:
    """Knobs of the gap / interval / window / feature pipeline.

    ``bucket_ns`` is the time bucket that spreads one series over many tasks:
    rows are shuffled by (key, bucket), so a key that holds a third of all
    rows is still split by time.  It must be at least ``window_ns`` so that a
    window touches at most two buckets; it defaults to ``window_ns``.
    """

    gap_ns: int = GAP_NS
    window_ns: int = WINDOW_NS
    min_rows: int = MIN_GROUP_ROWS
    peak_fraction: float = PEAK_FRACTION
    bucket_ns: int | None = None
    keys: tuple[str, ...] = ("user_id", "activity")

    @property
    def bucket(self) -> int:
        b = self.bucket_ns or self.window_ns
        if b < self.window_ns:
            raise ValueError("bucket_ns must be >= window_ns")
        return b


@dataclass(frozen=True)
class ForestParams:
    num_trees: int = RF_NUM_TREES
    max_depth: int = RF_MAX_DEPTH
    max_bins: int = RF_MAX_BINS
    impurity: str = RF_IMPURITY
    feature_subset: str = RF_FEATURE_SUBSET
    seed: int = RF_SEED
    num_classes: int = NUM_CLASSES


@dataclass(frozen=True)
class TreeParams:
    max_depth: int = DT_MAX_DEPTH
    max_bins: int = DT_MAX_BINS
    impurity: str = DT_IMPURITY
    num_classes: int = NUM_CLASSES


@dataclass(frozen=True)
class ProgressParams:
    step: int = PROGRESS_STEP
    snap_from: int = PROGRESS_SNAP_FROM
    full: int = PROGRESS_FULL
    publish_above: int = PUBLISH_ABOVE
    divisor: float = SCORE_DIVISOR
    moving_labels: tuple[float, ...] = field(default=MOVING_LABELS)
