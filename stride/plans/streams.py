"""Registered stream queries: every call runs its stream to completion and reads the sinks back.

The input is written once, partitioned by ten-day chunk, below the shared
checkpoint folder.  The query is started once per chunk with ``availableNow``,
so every run after the first restarts from the checkpoint with live state.
Chunks arrive in time order, so the stream result must equal its batch twin
(same oracle).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import progress as prog
from ..session import scratch_path
from ..sources import fixtures as fx
from ..sources.tables import REQUEST_SCHEMA
from ..streaming import progress as sprog
from ..streaming import scoring as sscore
from . import saved_models

CHUNK_NS = 10 * 24 * fx.HOUR_NS  # ten days of input per run
PROGRESS_IN_SCHEMA = "user_id string, event_id long, ts_ns long, score double"


def _chunked_runs(spark: SparkSession, src: DataFrame, ts: str, root: str, schema, writer) -> None:
    """Write ``src`` partitioned by chunk; run the stream once per chunk, in time order."""
    src.withColumn("_chunk", F.expr(f"{ts} div {CHUNK_NS}L")).write.partitionBy("_chunk").parquet(f"{root}/chunks")
    chunks = spark.read.parquet(f"{root}/chunks")
    # one row per chunk, from folder names
    for (c,) in chunks.select("_chunk").distinct().orderBy("_chunk").collect():
        # arrival of one chunk: only its folder is read
        chunks.filter(F.col("_chunk") == c).drop("_chunk").write.parquet(f"{root}/in/c{int(c):06d}")
        stream = spark.readStream.schema(schema).parquet(f"{root}/in/*")
        q = (stream.writeStream.option("checkpointLocation", f"{root}/checkpoint").foreachBatch(writer)
             .trigger(availableNow=True).start())
        q.awaitTermination()
        if q.exception() is not None:
            raise RuntimeError(str(q.exception()))


def run_progress_stream(spark: SparkSession, sf_dir: str, history: DataFrame | None = None,
                        scores: DataFrame | None = None) -> str:
    from .registry import _progress_events  # the moving events of the fixture

    root = scratch_path(spark, "stream-progress")
    ev = fx.events(spark, sf_dir)
    sprog.start_state(spark, f"{root}/out", fx.progress_history(ev) if history is None else history, scores)
    _chunked_runs(spark, _progress_events(spark, sf_dir), "ts_ns", root, PROGRESS_IN_SCHEMA,
                  sprog.progress_writer(f"{root}/out"))
    return f"{root}/out"


def run_scoring_stream(spark: SparkSession, sf_dir: str) -> str:
    root = scratch_path(spark, "stream-scoring")
    model = saved_models.load(spark, "rf")  # loaded once for the whole stream
    ev = fx.events(spark, sf_dir)
    fx.live(ev).write.parquet(f"{root}/live")  # the stored live table, which every batch reads in its time span
    _chunked_runs(spark, fx.requests(ev), "request_ts", root, REQUEST_SCHEMA,
                  sscore.scoring_writer(lambda: spark.read.parquet(f"{root}/live"), model, f"{root}/out"))
    return f"{root}/out"


def _read(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).drop("batch_id")


def q_stream_progress(spark, d):
    return _read(spark, f"{run_progress_stream(spark, d)}/states")


def q_stream_published(spark, d):
    return _read(spark, f"{run_progress_stream(spark, d)}/published")


def q_stream_progress_latest(spark, d):
    """Current progress per user from the stream's upsert sink (latest row wins)."""
    return prog.latest_progress(_read(spark, f"{run_progress_stream(spark, d)}/progress"))


def q_stream_scores(spark, d):
    """Per-event scores the stream stored; part of the devices start from zero or with stored scores."""
    ev = fx.events(spark, d)
    out = run_progress_stream(spark, d, fx.progress_history(ev, fx.HISTORY_EVERY), fx.stored_scores(ev))
    return _read(spark, f"{out}/scores")


def q_stream_scoring(spark, d):
    return _read(spark, f"{run_scoring_stream(spark, d)}/results").select(
        "request_id", "user_id", "start_ts", "finish_ts", "n_rows", "prediction")


def q_stream_dead_letters(spark, d):
    return _read(spark, f"{run_scoring_stream(spark, d)}/dead")
