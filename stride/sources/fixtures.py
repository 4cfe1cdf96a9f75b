"""Mapping of the driver's ``events`` table onto the motion tables.

Ten source users are folded into one device so that (device, activity)
series are long enough to pass the > 100 row gate.  Every derived table is a
projection of the whole ``events`` table, so the work grows with it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# FIXED VALUES of the fixture mapping (FIXTURES.md section B).
# ---------------------------------------------------------------------------
EVENT_ACTIVITY = {
    "click": "Walking",
    "error": "Jogging",
    "purchase": "Standing",
    "signup": "Sitting",
    "view": "Upstairs",
}
USERS_PER_DEVICE = 10
UUID_PREFIX = "00000000-0000-0000-0000-"
HOUR_NS = 3_600_000_000_000
FIXTURE_GAP_NS = 12 * HOUR_NS
FIXTURE_WINDOW_NS = 6 * HOUR_NS
FIXTURE_REQUEST_SPAN_NS = 24 * HOUR_NS
# Request message shapes, chosen by event_id % 7 (every event is one message).
REQUEST_SHAPES = 7
# Stored progress history: 'signup' events carry a progress of 88 + event_id % 15.
SCORE_EVENT = "error"  # its rows are scores stored earlier
HISTORY_EVERY = 3  # the second mapping: only every third device has stored progress
PROGRESS_EVENT = "signup"
PROGRESS_BASE = 88
PROGRESS_SPREAD = 15


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet")


def _ts_ns() -> F.Column:
    # time-zone independent: micros since the epoch of the NTZ value
    return F.expr("timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts)") * F.lit(1000)


def _axes() -> list[F.Column]:
    return [
        (F.col("value") / F.lit(10.0) - F.lit(5.0)).alias("acc_x"),
        ((F.get_json_object("props", "$.k").cast("bigint") - F.lit(50)) / F.lit(5.0)).alias("acc_y"),
        (((F.col("event_id") * F.lit(37)) % F.lit(100) - F.lit(50)) / F.lit(10.0)).alias("acc_z"),
    ]


def _activity() -> F.Column:
    m = F.create_map(*[x for k, v in EVENT_ACTIVITY.items() for x in (F.lit(k), F.lit(v))])
    return m[F.col("event_type")]


def device_id() -> F.Column:
    return F.expr(f"user_id div {USERS_PER_DEVICE}")


def device_uuid() -> F.Column:
    return F.concat(F.lit(UUID_PREFIX), F.lpad(device_id().cast("string"), 12, "0"))


def labelled(ev: DataFrame, with_event_id: bool = False) -> DataFrame:
    """events -> labelled accelerations (user_id, activity, ts_ns, acc_x, acc_y, acc_z)."""
    cols = [device_id().alias("user_id"), _activity().alias("activity"), _ts_ns().alias("ts_ns"), *_axes()]
    if with_event_id:
        cols.append(F.col("event_id"))
    return ev.select(*cols)


def live(ev: DataFrame) -> DataFrame:
    """events -> live accelerations (uuid user, timestamp == timestamp_long in ns)."""
    ts = _ts_ns()
    ax = _axes()
    return ev.select(
        device_uuid().alias("user_id"),
        ts.alias("timestamp"),
        ts.alias("timestamp_long"),
        ax[0].alias("x"),
        ax[1].alias("y"),
        ax[2].alias("z"),
    )


def requests(ev: DataFrame, span_ns: int = FIXTURE_REQUEST_SPAN_NS) -> DataFrame:
    """events -> request messages, one per event, in seven shapes.

    shape 0 ``user,ts``            too short -> dead letter
    shape 1 ``''``                 empty -> dead letter
    shape 2 ``user,abc,ts``        bad number -> dead letter
    shape 3 ``not-a-uuid,ts-D,ts`` bad identifier -> prediction -1
    shape 4 ``user,ts,ts-D,extra`` reversed range -> empty -> -1
    shape 5 ``user,ts-D,ts,extra`` good, extra field ignored
    shape 6 ``user,ts-D,ts``       good
    """
    ts = _ts_ns()
    u = device_uuid()
    t = ts.cast("string")
    t0 = (ts - F.lit(span_ns)).cast("string")
    shape = F.col("event_id") % F.lit(REQUEST_SHAPES)
    body = (
        F.when(shape == 0, F.concat_ws(",", u, t))
        .when(shape == 1, F.lit(""))
        .when(shape == 2, F.concat_ws(",", u, F.lit("abc"), t))
        .when(shape == 3, F.concat_ws(",", F.lit("not-a-uuid"), t0, t))
        .when(shape == 4, F.concat_ws(",", u, t, t0, F.lit("extra")))
        .when(shape == 5, F.concat_ws(",", u, t0, t, F.lit("extra")))
        .otherwise(F.concat_ws(",", u, t0, t))
    )
    return ev.select(F.col("event_id").alias("request_id"), ts.alias("request_ts"), body.alias("value"))


def _stored_ms() -> F.Column:
    return F.expr("timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts) div 1000")


def stored_scores(ev: DataFrame) -> DataFrame:
    """events -> scores stored earlier, for every second device (user uuid, timestamp in ms, perfect_number)."""
    return ev.filter((F.col("event_type") == SCORE_EVENT) & (device_id() % 2 == 1)).select(
        device_uuid().alias("user_id"), _stored_ms().alias("timestamp"), (F.col("value") / F.lit(10.0)).alias("perfect_number"))


def progress_history(ev: DataFrame, every: int = 1) -> DataFrame:
    """events -> stored progress rows of every n-th device (user uuid, walking_progress, timestamp in ms)."""
    return ev.filter((F.col("event_type") == PROGRESS_EVENT) & (device_id() % every == 0)).select(
        device_uuid().alias("user_id"),
        (F.lit(PROGRESS_BASE) + (F.col("event_id") % F.lit(PROGRESS_SPREAD))).cast("int").alias("walking_progress"),
        _stored_ms().alias("timestamp"),
    )
