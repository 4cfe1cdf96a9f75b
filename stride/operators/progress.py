"""Walking progress and published scores, in closed form for a batch.

Per moving event the original runs, in order: (1) raise: below full, snap to
full from ``snap_from`` else + step; (2) save: if still below full, store the
event's score; (3) publish: if publish_above < progress <= full, store the
mean of all stored scores and set progress to full.

For a user starting at p0 with events k = 1, 2, ... in order, let m be the
first event that publishes.  Then
  progress(k) = p0 if p0 > full, full if k >= m, else p0 + step * k
  saved(k)    = k < m, or k == m and the m-th raise stays below full
  published(k)= p0 <= full and k >= m
and every publication carries the mean of the prior stored scores plus the
saved ones (saved events are a prefix, so it is the same value each time).
Everything is a grouped aggregate or a bucketed running count.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions.scalar import floor_div
from . import series


def first_publish(p0: F.Column, P: C.ProgressParams) -> F.Column:
    """Index m of the first publishing event for start p0 (NULL when none)."""
    # first k with p0 + step * k > publish_above
    by_step = F.floor((F.lit(P.publish_above) - p0) / F.lit(P.step)).cast("bigint") + 1
    # the raise that starts at or above snap_from jumps to full (which publishes)
    by_snap = F.ceil((F.lit(P.snap_from) - p0) / F.lit(P.step)).cast("bigint") + 1
    below = F.least(by_step, by_snap)
    return (
        F.when(p0 > P.full, F.lit(None).cast("bigint"))
        .when(p0 > P.publish_above, F.lit(1).cast("bigint"))
        .otherwise(below)
    )


def progress_states(events: DataFrame, start: DataFrame | None, prior_scores: DataFrame | None,
                    P: C.ProgressParams = C.ProgressParams(), ts: str = "ts_ns", tiebreak: tuple[str, ...] = ("event_id",),
                    score: str = "score", bucket_ns: int = 86_400_000_000_000,
                    prior: DataFrame | None = None) -> DataFrame:
    """Per moving event: k, progress after it, saved / published flags and the published value.

    ``events``: user_id, ts, tiebreak columns, score (already the moving ones).
    ``start``: user_id, walking_progress (one row per user; missing -> 0).
    ``prior_scores``: user_id, perfect_number (scores stored before this batch),
    or ``prior``: their totals per user (see :func:`score_totals`).

    The events stay partitioned by (user, time bucket) from the running count;
    per-user values (start progress, published mean) are attached to the small
    one-row-per-bucket table and joined back on (user, bucket), so no event is
    re-shuffled by user and a user with a third of all events is not one task.
    """
    keys = ["user_id"]
    ev = series.running_count(events, keys, ts, list(tiebreak), bucket_ns, out="k", keep_bucket=True)
    buckets = series.bucket_counts(events, keys, ts, bucket_ns).select(*keys, series.BUCKET)
    if start is not None:
        buckets = buckets.join(start.select("user_id", F.col("walking_progress").alias("p0")), on="user_id",
                               how="left")
    else:
        buckets = buckets.select("*", F.lit(None).cast("int").alias("p0"))
    buckets = buckets.select(*keys, series.BUCKET, F.coalesce(F.col("p0"), F.lit(0)).cast("bigint").alias("p0"))
    ev = ev.join(buckets, on=[*keys, series.BUCKET], how="inner")

    p0, k = F.col("p0"), F.col("k")
    m = first_publish(p0, P)
    raise_at_m = F.when(p0 + F.lit(P.step) * (m - 1) >= F.lit(P.snap_from), F.lit(P.full)).otherwise(
        p0 + F.lit(P.step) * m)
    saved = (p0 < F.lit(P.full)) & (m.isNull() | (k < m) | ((k == m) & (raise_at_m < F.lit(P.full))))
    published = m.isNotNull() & (k >= m)
    progress = (
        F.when(p0 > F.lit(P.full), p0)
        .when(published, F.lit(P.full))
        .otherwise(p0 + F.lit(P.step) * k)
    )
    ev = ev.select("*", saved.alias("saved"), published.alias("published"), progress.cast("int").alias("progress"))

    # saved scores form a prefix of each user's events: one grouped aggregate
    per_user = ev.groupBy("user_id").agg(
        F.sum(F.when(F.col("saved"), F.col(score))).alias("_ssum"),
        F.count(F.when(F.col("saved"), F.lit(1))).alias("_sn"),
    )
    if prior_scores is not None:
        prior = score_totals(prior_scores)
    if prior_scores is not None or prior is not None:
        per_user = per_user.join(prior, on="user_id", how="left")
    else:
        per_user = per_user.select("*", F.lit(None).cast("double").alias("_psum"),
                                   F.lit(None).cast("bigint").alias("_pn"))
    total_n = F.coalesce(F.col("_sn"), F.lit(0)) + F.coalesce(F.col("_pn"), F.lit(0))
    total = F.coalesce(F.col("_ssum"), F.lit(0.0)) + F.coalesce(F.col("_psum"), F.lit(0.0))
    per_user = per_user.select("user_id", F.when(total_n > 0, total / total_n).otherwise(F.lit(0.0)).alias("_mean"))
    means = buckets.select(*keys, series.BUCKET).join(per_user, on="user_id", how="left")
    ev = ev.join(means, on=[*keys, series.BUCKET], how="inner")
    keep = [c for c in ev.columns if c not in ("_mean", series.BUCKET)]
    return ev.select(*keep, F.when(F.col("published"), F.col("_mean")).alias("published_value"))


def score_totals(scores: DataFrame) -> DataFrame:
    """user_id, _psum, _pn: sum and number of stored scores."""
    return scores.groupBy("user_id").agg(F.sum("perfect_number").alias("_psum"), F.count(F.lit(1)).alias("_pn"))


def latest_progress(history: DataFrame) -> DataFrame:
    """Latest stored progress per user (row with the largest timestamp; of equal ones the largest progress)."""
    return history.groupBy("user_id").agg(
        F.max_by("walking_progress", F.struct("timestamp", "walking_progress")).alias("walking_progress"),
        F.max("timestamp").alias("timestamp"),
    )


def progress_for(users: DataFrame, history: DataFrame) -> DataFrame:
    """Stored progress of each user, 0 when the user has none."""
    latest = latest_progress(history).select("user_id", "walking_progress")
    return users.select("user_id").distinct().join(latest, on="user_id", how="left").select(
        "user_id", F.coalesce(F.col("walking_progress"), F.lit(0)).alias("walking_progress"))


def stored_time(ts: str) -> F.Column:
    """Event time as the stored tables count it: milliseconds."""
    return floor_div(ts, 1_000_000)


def stored_scores(states: DataFrame, ts: str = "ts_ns", score: str = "score") -> DataFrame:
    """Rows of the per-event score table: the saved events."""
    return states.filter("saved").select("user_id", stored_time(ts).alias("timestamp"), F.col(score).alias("perfect_number"))


def progress_upserts(states: DataFrame, ts: str = "ts_ns", P: C.ProgressParams = C.ProgressParams()) -> DataFrame:
    """The stored progress after the given states; a user beyond full is never written."""
    return states.filter(F.col("progress") <= F.lit(P.full)).groupBy("user_id").agg(
        F.max_by("progress", "k").alias("walking_progress"), F.max(stored_time(ts)).alias("timestamp"))


def published_rows(states: DataFrame, ts: str = "ts_ns") -> DataFrame:
    """Rows of the published-score table: the eleven feature columns are written as zeros."""
    zeros = [F.lit(0.0).alias(c) for c in C.FEATURE_COLUMNS]
    p = states.filter("published")
    return p.select(
        "user_id",
        stored_time(ts).alias("timestamp"),
        stored_time(ts).alias("timestamp_long"),
        *zeros,
        F.col("published_value").alias("perfect_number"),
    )
