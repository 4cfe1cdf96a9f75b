"""Sinks for progress, scores and published rows (append-only, compacted on read).

The original upserted single rows into a wide-row store.  Here every write
appends a batch of rows; "the current progress of a user" is the row with
the latest timestamp (``operators.progress.latest_progress``), and
``compact_progress`` rewrites a folder to one row per user when it grows.
Writers take a ``batch_id`` so a retried micro-batch overwrites its own
folder instead of appending twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators.progress import latest_progress, published_rows
from .tables import read_progress


def _write(df: DataFrame, path: str, batch_id: int | None) -> str:
    if batch_id is None:
        df.write.mode("append").parquet(path)
        return path
    target = f"{path}/batch_id={batch_id}"
    df.write.mode("overwrite").parquet(target)
    return target


def upsert_progress(df: DataFrame, path: str, batch_id: int | None = None) -> str:
    """Append (user_id, walking_progress, timestamp) rows; the latest per user wins on read."""
    return _write(df.select("user_id", "walking_progress", "timestamp"), path, batch_id)


def append_scores(df: DataFrame, path: str, batch_id: int | None = None) -> str:
    """Append per-event scores (user_id, timestamp, perfect_number)."""
    return _write(df.select("user_id", "timestamp", "perfect_number"), path, batch_id)


def append_published(states: DataFrame, path: str, batch_id: int | None = None) -> str:
    """Append the published rows of a progress-state result (features written as zeros)."""
    return _write(published_rows(states), path, batch_id)


def current_progress(spark: SparkSession, path: str) -> DataFrame:
    """Latest stored progress per user from an upserted folder."""
    return latest_progress(read_progress(spark, path))


def compact_progress(spark: SparkSession, path: str, out: str) -> str:
    """Rewrite the folder as one row per user into ``out`` (a new version folder)."""
    current_progress(spark, path).write.mode("overwrite").parquet(out)
    return out
