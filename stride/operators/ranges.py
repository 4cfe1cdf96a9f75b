"""Integer ranges, windows and the bucketed range join.

Spark has no range join, so a span (lo, hi) is matched to readings by an
equi-join on (key, time bucket) plus the exact range as a residual
predicate.  Readings are bucketed once (their shuffle is shared with the
series scan); each span is exploded into the buckets it touches.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .series import BUCKET

# Largest array a single generator row may build; longer ranges are cut into chunks.
CHUNK = 4096


def explode_range(df: DataFrame, lo: Column, hi: Column, out: str, chunk: int = CHUNK,
                  spread_by: list[str] | None = None) -> DataFrame:
    """One row per integer in [lo, hi] (none when lo > hi), arrays bounded by ``chunk``.

    Two generator levels: chunks of ``chunk`` integers, then the integers of
    each chunk, so no row ever builds an array longer than ``chunk`` however
    long the range is.  With ``spread_by`` the chunk rows are hash
    distributed on (spread_by, chunk) before the second level, so one very
    long range is generated by many tasks (AQE merges the partitions again
    when the chunk rows are few).
    """
    cols = df.columns
    d = df.filter(lo <= hi).select(*cols, lo.alias("_lo"), hi.alias("_hi"))
    n_chunks = F.expr(f"(_hi - _lo) div {chunk}L")
    d = d.select(*cols, "_lo", "_hi", F.explode(F.sequence(F.lit(0).cast("bigint"), n_chunks)).alias("_chunk"))
    if spread_by:
        d = d.repartition(*spread_by, "_chunk")
    start = F.col("_lo") + F.col("_chunk") * F.lit(chunk)
    stop = F.least(F.col("_hi"), start + F.lit(chunk - 1))
    return d.select(*cols, F.explode(F.sequence(start, stop)).alias(out))


def end_anchored_windows(iv: DataFrame, window_ns: int, keys: Sequence[str] = ("user_id", "activity")) -> DataFrame:
    """Windows j = 0..n of each interval: (end + (j-1)W, end + jW), open at both ends.

    Window 0 is the last W before the interval end; j >= 1 lie after it (the
    original anchoring, kept for parity).
    """
    # one long recording can have millions of windows: spread their generation
    w = explode_range(iv, F.lit(0).cast("bigint"), F.col("n_windows"), "window_index",
                      spread_by=[*keys, "interval_id"])
    return w.select(
        "*",
        (F.col("interval_end") + (F.col("window_index") - 1) * F.lit(window_ns)).alias("window_lo"),
        (F.col("interval_end") + F.col("window_index") * F.lit(window_ns)).alias("window_hi"),
    )


def start_anchored_windows(scanned: DataFrame, ts: str, window_ns: int) -> DataFrame:
    """Every reading with its window of its own interval, half open: [start + jW, start + (j + 1)W).

    ``scanned`` carries the start of the reading's interval (``series_scan``), so
    the window is arithmetic on the row: no join, and a reading has one window.
    """
    j = F.expr(f"(`{ts}` - interval_start) div {int(window_ns)}L")
    lo = F.col("interval_start") + F.col("window_index") * F.lit(window_ns)
    return scanned.select("*", j.alias("window_index")).select(
        "*", lo.alias("window_lo"), (lo + F.lit(window_ns)).alias("window_hi"))


def _bucket_of(expr: str, bucket_ns: int) -> Column:
    return F.expr(f"(({expr}) - pmod({expr}, {bucket_ns}L)) div {bucket_ns}L")


def _span_buckets(spans: DataFrame, lo: str, hi: str, closed: bool, bucket_ns: int) -> DataFrame:
    first = f"`{lo}`" if closed else f"(`{lo}` + 1)"
    last = f"`{hi}`" if closed else f"(`{hi}` - 1)"
    return explode_range(spans, _bucket_of(first, bucket_ns), _bucket_of(last, bucket_ns), BUCKET)


def in_span(ts: Column, lo: Column, hi: Column, closed: bool) -> Column:
    return (ts >= lo) & (ts <= hi) if closed else (ts > lo) & (ts < hi)


def range_members(spans: DataFrame, readings: DataFrame, keys: Sequence[str], ts: str, lo: str, hi: str,
                  closed: bool, bucket_ns: int, how: str = "inner") -> DataFrame:
    """Span rows joined with the readings of the same key inside (lo, hi) / [lo, hi].

    ``readings`` must carry ``_bucket`` computed with the same ``bucket_ns``
    (see ``series.local_order``); it is then already partitioned on the join
    keys.  Span length is unbounded: a span explodes into one row per bucket
    it covers, so the join output never holds a pair that is out of range
    by more than one bucket.
    """
    sb = _span_buckets(spans, lo, hi, closed, bucket_ns)
    # spans may derive from the readings (second feature pass): rename the
    # readings' join columns so the self-join is unambiguous.
    ren = {k: f"_r_{k}" for k in [*keys, BUCKET]}
    r = readings.select(*[F.col(c).alias(ren.get(c, c)) for c in readings.columns])
    cond = [F.col(k) == F.col(ren[k]) for k in [*keys, BUCKET]]
    cond.append(in_span(F.col(ts), F.col(lo), F.col(hi), closed))
    j = sb.join(r, on=_and(cond), how=how)
    return j.drop(*ren.values(), BUCKET)


def _and(cs: list[Column]) -> Column:
    out = cs[0]
    for c in cs[1:]:
        out = out & c
    return out
