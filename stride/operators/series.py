"""Ordered-series operators: previous reading, gaps, jumps and recording intervals.

A (user, activity) series is never sent through one task.  Rows are shuffled
once by (key, time bucket); inside a bucket an ordered window gives the
local previous reading and running jump count.  Only one summary row per
non-empty bucket goes through a per-key window (its size is bounded by the
time span of the key, not by its row count), and the summaries are joined
back on (key, bucket), which is already the partitioning of the rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import floor_div

BUCKET = "_bucket"
SUPER = "_super"
# Buckets per super-bucket.  The carry values (previous reading, jumps before)
# are computed on two levels so that no window partition holds more than
# FANOUT bucket rows or span / (bucket * FANOUT) super-bucket rows of one key.
FANOUT = 1024


def with_bucket(df: DataFrame, ts: str, bucket_ns: int) -> DataFrame:
    return df.select("*", floor_div(ts, bucket_ns).alias(BUCKET))


# The builders below use few select() calls instead of withColumn chains:
# every DataFrame step is analysed eagerly, and on these self-joined plans a
# chain of withColumn costs seconds of driver time before any task runs.

def _carry_keys_present(fanout: int) -> F.Column:
    # Trivially true once ts is present; stated explicitly so that every
    # consumer of the (key, bucket) shuffle carries the same constraints.  The
    # joins on bucket / super-bucket would otherwise infer these not-null
    # filters on some branches only, the exchanges would differ and Spark
    # could not reuse one shuffle for all of them.
    return F.col(BUCKET).isNotNull() & floor_div(BUCKET, fanout).isNotNull()


def local_order(df: DataFrame, keys: Sequence[str], ts: str, bucket_ns: int, gap_ns: int,
                tie_desc: str | None = None, fanout: int = FANOUT, tie_asc: str | None = None) -> DataFrame:
    """Per (key, bucket), ordered by ts (ties: ``tie_asc`` ascending, then ``tie_desc`` descending).

    Adds ``_prev_local`` (previous ts inside the bucket), ``_jump_local``,
    ``_cum_local`` (running jump count inside the bucket), ``_start_so_far``
    (last reading after a gap inside the bucket), with ``tie_asc`` also
    ``first_of_tie`` (first row of its timestamp and tie), and ``first_of_ts``
    (first row of its timestamp; with ``tie_desc`` it is the one with the
    largest tie value).  The result is hash partitioned by (keys, bucket).
    """
    b = df if BUCKET in df.columns else with_bucket(df, ts, bucket_ns)
    b = b.filter(_carry_keys_present(fanout))
    order = [F.col(ts).asc()] + ([F.col(tie_asc).asc()] if tie_asc else []) + ([F.col(tie_desc).desc()] if tie_desc else [])
    w = Window.partitionBy(*keys, BUCKET).orderBy(*order)
    fresh = [] if tie_asc is None else [
        F.coalesce((F.lag(ts).over(w) != F.col(ts)) | (F.lag(tie_asc).over(w) != F.col(tie_asc)), F.lit(True)).alias("first_of_tie")]
    b = b.select("*", F.lag(ts).over(w).alias("_prev_local"), *fresh)
    jump = F.coalesce((F.col(ts) - F.col("_prev_local") > F.lit(gap_ns)).cast("int"), F.lit(0))
    running = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return b.select(
        "*",
        jump.alias("_jump_local"),
        F.coalesce(F.col("_prev_local") != F.col(ts), F.lit(True)).alias("first_of_ts"),
        F.sum(jump).over(running).alias("_cum_local"),
        F.max(F.when(jump == 1, F.col(ts))).over(running).alias("_start_so_far"),
    )


def bucket_summaries(local: DataFrame, keys: Sequence[str], ts: str, gap_ns: int,
                     fanout: int = FANOUT) -> DataFrame:
    """One row per non-empty (key, bucket) with the cross-bucket carry values.

    ``_prev_last``: last reading of the previous non-empty bucket of the key;
    ``_edge_jump``: whether the bucket's first reading starts an interval;
    ``_jumps_before``: jumps strictly before the bucket's first reading;
    ``_start``: start of the interval the bucket's first reading lies in.  An
    interval starts at a key's first reading and at every reading after a gap,
    and starts ascend, so the one in force is the greatest so far.

    Level 1 orders the buckets inside a super-bucket (key, bucket div fanout);
    level 2 orders the super-buckets of a key (one row each).
    """
    s = local.groupBy(*keys, BUCKET).agg(
        F.min(ts).alias("_bfirst"),
        F.max(ts).alias("_blast"),
        F.count(F.lit(1)).alias("_bn"),
        F.sum("_jump_local").cast("bigint").alias("_bjumps"),
        F.max(F.when(F.col("_jump_local") == 1, F.col(ts))).alias("_bstart"),
    )
    s = s.select("*", floor_div(BUCKET, fanout).alias(SUPER))
    ws = Window.partitionBy(*keys, SUPER).orderBy(BUCKET)
    s = s.select("*", F.lag("_blast").over(ws).alias("_prev_last_local"))
    edge_local = F.coalesce((F.col("_bfirst") - F.col("_prev_last_local") > F.lit(gap_ns)).cast("bigint"),
                            F.lit(0).cast("bigint"))
    s = s.select(
        "*",
        edge_local.alias("_edge_local"),
        F.coalesce(F.sum(edge_local + F.col("_bjumps")).over(ws.rowsBetween(Window.unboundedPreceding, -1)),
                   F.lit(0)).cast("bigint").alias("_local_before"),
        # starts inside earlier buckets of the super-bucket, and at the edge of this one
        F.greatest(F.max(F.greatest("_bstart", F.when(edge_local == 1, F.col("_bfirst")))).over(
            ws.rowsBetween(Window.unboundedPreceding, -1)), F.when(edge_local == 1, F.col("_bfirst"))).alias("_start_local"),
    )
    # level 2: one row per (key, super-bucket); same partitioning, no exchange
    ss = s.groupBy(*keys, SUPER).agg(
        F.min("_bfirst").alias("_sfirst"),
        F.max("_blast").alias("_slast"),
        F.sum("_bn").alias("_sn"),
        F.sum(F.col("_edge_local") + F.col("_bjumps")).alias("_sinternal"),
        F.max(F.greatest("_bstart", "_start_local")).alias("_sstart"),
    )
    wk = Window.partitionBy(*keys).orderBy(SUPER)
    whole = Window.partitionBy(*keys)
    ss = ss.select("*", F.lag("_slast").over(wk).alias("_prev_slast"))
    edge_super = F.coalesce((F.col("_sfirst") - F.col("_prev_slast") > F.lit(gap_ns)).cast("bigint"),
                            F.lit(0).cast("bigint"))
    ss = ss.select(
        *keys,
        SUPER,
        "_prev_slast",
        edge_super.alias("_edge_super"),
        F.coalesce(F.sum(edge_super + F.col("_sinternal")).over(wk.rowsBetween(Window.unboundedPreceding, -1)),
                   F.lit(0)).cast("bigint").alias("_super_before"),
        # the start in force when the super-bucket begins: its own edge, an earlier one's, or the key's first reading
        F.greatest(F.max(F.greatest("_sstart", F.when(edge_super == 1, F.col("_sfirst")))).over(
            wk.rowsBetween(Window.unboundedPreceding, -1)), F.when(edge_super == 1, F.col("_sfirst")),
            F.min("_sfirst").over(whole)).alias("_super_start"),
        F.sum("_sn").over(whole).alias("key_rows"),
        F.min("_sfirst").over(whole).alias("key_first"),
        F.max("_slast").over(whole).alias("key_last"),
    )
    j = s.join(ss, on=[*keys, SUPER], how="inner")
    first_in_super = F.col("_prev_last_local").isNull()
    return j.select(
        *keys,
        BUCKET,
        F.coalesce(F.col("_prev_last_local"), F.col("_prev_slast")).alias("_prev_last"),
        F.when(first_in_super, F.col("_edge_super")).otherwise(F.col("_edge_local")).alias("_edge_jump"),
        (F.col("_super_before") + F.when(first_in_super, F.lit(0)).otherwise(F.col("_edge_super"))
         + F.col("_local_before")).alias("_jumps_before"),
        F.greatest("_super_start", "_start_local").alias("_start"),
        "key_rows",
        "key_first",
        "key_last",
    )


def series_scan(df: DataFrame, keys: Sequence[str], ts: str, gap_ns: int, bucket_ns: int,
                tie_desc: str | None = None, fanout: int = FANOUT) -> DataFrame:
    """Every row with its series context.

    Adds ``prev_ts`` (previous reading of the same key, NULL for the first),
    ``delta``, ``is_jump`` (delta > gap), ``interval_id`` (number of jumps at or
    before the row, so the first interval is 0), ``interval_start`` (its first
    reading), ``key_rows``, ``key_first``,
    ``key_last`` and ``first_of_ts``.  ``df`` may already be the output of
    ``local_order`` (then its shuffle is shared with other consumers of it).
    """
    local = df if "_cum_local" in df.columns else local_order(df, keys, ts, bucket_ns, gap_ns, tie_desc, fanout)
    summ = bucket_summaries(local, keys, ts, gap_ns, fanout)
    j = local.join(summ, on=[*keys, BUCKET], how="inner")
    prev = F.coalesce(F.col("_prev_local"), F.col("_prev_last"))
    delta = F.col(ts) - prev
    internal = {"_prev_local", "_jump_local", "_cum_local", "_start_so_far", "_prev_last", "_edge_jump", "_jumps_before", "_start"}
    keep = [c for c in j.columns if c not in internal]
    return j.select(
        *keep,
        prev.alias("prev_ts"),
        delta.alias("delta"),
        F.coalesce(delta > F.lit(gap_ns), F.lit(False)).alias("is_jump"),
        (F.col("_jumps_before") + F.col("_edge_jump") + F.col("_cum_local")).alias("interval_id"),
        F.greatest("_start", "_start_so_far").alias("interval_start"),
    )


def group_gate(df: DataFrame, keys: Sequence[str], min_rows: int) -> DataFrame:
    """Row count per key and whether it passes the strict > min_rows gate."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).withColumn(
        "passes", F.col("n_rows") > F.lit(min_rows)
    )


def series_bounds(df: DataFrame, keys: Sequence[str], ts: str) -> DataFrame:
    """First / last timestamp and row count of every series (partial aggregation)."""
    return df.groupBy(*keys).agg(
        F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts"), F.count(F.lit(1)).alias("n_rows")
    )


def gap_deltas(scanned: DataFrame, keys: Sequence[str], ts: str) -> DataFrame:
    """(later, earlier, delta) for every reading that has a predecessor in its series."""
    return scanned.filter(F.col("prev_ts").isNotNull()).select(*keys, ts, "prev_ts", "delta")


def jumps(scanned: DataFrame, keys: Sequence[str], ts: str) -> DataFrame:
    """(before, after) pairs whose distance is larger than the gap."""
    return scanned.filter("is_jump").select(
        *keys, F.col("prev_ts").alias("before_ts"), F.col(ts).alias("after_ts"), "delta"
    )


def jump_boundaries(jmp: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Each jump as its two boundary times."""
    return jmp.select(*keys, F.explode(F.array("before_ts", "after_ts")).alias("boundary_ts"))


def intervals(scanned: DataFrame, keys: Sequence[str], ts: str, window_ns: int,
              min_rows: int | None = None) -> DataFrame:
    """Recording intervals [start, end] with their window count (end - start) div window.

    Only series with more than ``min_rows`` rows when a gate is given.  The
    grouping is pre-aggregated map side, so one long interval costs one
    partial row per task.
    """
    s = scanned if min_rows is None else scanned.filter(F.col("key_rows") > F.lit(min_rows))
    g = s.groupBy(*keys, "interval_id").agg(
        F.min(ts).alias("interval_start"), F.max(ts).alias("interval_end"), F.count(F.lit(1)).alias("interval_rows")
    )
    return g.withColumn(
        "n_windows", F.expr(f"(interval_end - interval_start) div {int(window_ns)}L")
    )


def bucketed(df: DataFrame, ts: str, bucket_ns: int, fanout: int = FANOUT) -> DataFrame:
    """Rows with their time bucket (filtered the same way for every consumer)."""
    return with_bucket(df, ts, bucket_ns).filter(_carry_keys_present(fanout))


def bucket_counts(df: DataFrame, keys: Sequence[str], ts: str, bucket_ns: int, fanout: int = FANOUT) -> DataFrame:
    """One row per non-empty (key, bucket) with its row count (pre-aggregated before the shuffle)."""
    return bucketed(df, ts, bucket_ns, fanout).groupBy(*keys, BUCKET).agg(F.count(F.lit(1)).alias("_bn"))


def running_count(df: DataFrame, keys: Sequence[str], ts: str, tiebreak: Sequence[str], bucket_ns: int,
                  out: str = "k", fanout: int = FANOUT, keep_bucket: bool = False) -> DataFrame:
    """1-based position of each row in its key's order (ts, then tiebreak).

    Same layout as ``series_scan``: a row number inside each (key, time
    bucket), plus the count of all earlier buckets of the key from a
    two-level prefix over one row per bucket / super-bucket.  No key is sent
    through one task whole.  The result is partitioned by (keys, bucket);
    ``keep_bucket`` keeps the bucket column so later per-bucket joins reuse
    that partitioning.
    """
    b = bucketed(df, ts, bucket_ns, fanout)
    w = Window.partitionBy(*keys, BUCKET).orderBy(F.col(ts), *[F.col(c) for c in tiebreak])
    local = b.select("*", F.row_number().over(w).alias("_rn"))
    counts = bucket_counts(df, keys, ts, bucket_ns, fanout)
    counts = counts.select("*", floor_div(BUCKET, fanout).alias(SUPER))
    ws = Window.partitionBy(*keys, SUPER).orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("*", F.coalesce(F.sum("_bn").over(ws), F.lit(0)).cast("bigint").alias("_local_before"))
    supers = counts.groupBy(*keys, SUPER).agg(F.sum("_bn").alias("_sn"))
    wk = Window.partitionBy(*keys).orderBy(SUPER).rowsBetween(Window.unboundedPreceding, -1)
    supers = supers.select(*keys, SUPER, F.coalesce(F.sum("_sn").over(wk), F.lit(0)).cast("bigint").alias("_super_before"))
    counts = counts.join(supers, on=[*keys, SUPER], how="inner").select(
        *keys, BUCKET, (F.col("_super_before") + F.col("_local_before")).alias("_before"))
    j = local.join(counts, on=[*keys, BUCKET], how="inner")
    drop = ("_before", "_rn") if keep_bucket else ("_before", "_rn", BUCKET)
    keep = [c for c in j.columns if c not in drop]
    return j.select(*keep, (F.col("_before") + F.col("_rn")).alias(out))
