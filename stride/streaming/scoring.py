"""Request scoring on a stream: parse -> range features -> prediction, per micro-batch.

The model is loaded once when the query starts (the original loaded it per
request).  Each micro-batch is scored as one bulk job: the whole batch of
requests is range-joined to the live readings at once.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions.scalar import perfect_number
from ..operators import model as ml
from ..operators import requests as rq
from . import progress


def score_batch(msgs: DataFrame, live, model, bucket_ns: int = rq.REQUEST_BUCKET_NS):
    """(scored requests, dead letters) for a batch of messages.

    A live table is first cut to the time span the batch asks about (one
    small aggregate over the batch; the predicate reaches the scan), then to
    the users and time buckets asked for.  A live store opens the folders that
    are asked for.
    """
    return score_fields(rq.request_fields(msgs), live, model, bucket_ns)


def score_fields(fields: DataFrame, live, model, bucket_ns: int = rq.REQUEST_BUCKET_NS):
    """``score_batch`` of messages that are parsed already (``requests.request_fields``)."""
    parsed, dead = rq.split_requests(fields)
    if not isinstance(live, DataFrame):
        return ml.predict(model, rq.request_features(parsed, live, bucket_ns)), dead
    lo, hi = parsed.filter("valid_user AND start_ts <= finish_ts").agg(F.min("start_ts"), F.max("finish_ts")).first()
    if lo is None:
        live = live.filter(F.lit(False))  # no valid range in this batch
    else:
        live = live.filter((F.col("timestamp") >= F.lit(lo)) & (F.col("timestamp") <= F.lit(hi)))
    f = rq.request_features(parsed, live, bucket_ns)
    return ml.predict(model, f), dead


def score_step(msgs: DataFrame, batch_id: int, read_live: Callable[[], DataFrame], model, out_dir: str,
               bucket_ns: int = rq.REQUEST_BUCKET_NS) -> DataFrame:
    """Score one micro-batch against the live table as it is now; returns the written results.

    Results and dead letters go to ``batch_id=N`` folders (overwritten by a
    retry).  Messages are parsed once: time span, asked spans, results and dead
    letters all read the parsed fields.
    """
    part = f"batch_id={batch_id}"
    fields = rq.request_fields(msgs).persist()
    try:
        scored, dead = score_fields(fields, read_live(), model, bucket_ns)
        scored.write.mode("overwrite").parquet(f"{out_dir}/results/{part}")
        dead.write.mode("overwrite").parquet(f"{out_dir}/dead/{part}")
    finally:
        fields.unpersist()
    return msgs.sparkSession.read.parquet(f"{out_dir}/results/{part}")


def scoring_writer(read_live: Callable[[], DataFrame], model, out_dir: str, bucket_ns: int = rq.REQUEST_BUCKET_NS):
    """foreachBatch function: scoring alone."""

    def fn(batch: DataFrame, batch_id: int) -> None:
        score_step(batch, batch_id, read_live, model, out_dir, bucket_ns)

    return fn


def service_writer(read_live: Callable[[], DataFrame], model, out_dir: str, bucket_ns: int = rq.REQUEST_BUCKET_NS,
                   compact_every: int = 50):
    """foreachBatch function of the live service: score, then advance the progress of the moving users."""

    def fn(batch: DataFrame, batch_id: int) -> None:
        results = score_step(batch, batch_id, read_live, model, out_dir, bucket_ns)
        progress.step(moving_events(results), batch_id, f"{out_dir}/progress", compact_every=compact_every)

    return fn


def moving_events(results: DataFrame, moving_labels=C.MOVING_LABELS) -> DataFrame:
    """Scored requests -> moving events for the progress state (score = feature sum / 11)."""
    return results.filter(F.col("prediction").isin(*moving_labels)).select(
        "user_id", F.col("request_id").alias("event_id"), F.col("request_ts").alias("ts_ns"),
        perfect_number().alias("score"),
    )
