"""DuckDB oracle SQL for the registered queries.

Each statement follows the original semantics directly (whole-series lag,
plain range join, per-window ordered peaks) and is independent of the
Spark plan, so agreement is a real check.  The fixture mapping of ``events``
is the same as ``sources.fixtures``.
"""

from __future__ import annotations

from .. import config as C
from ..sources import fixtures as fx

GAP = fx.FIXTURE_GAP_NS
WIN = fx.FIXTURE_WINDOW_NS
GATE = C.MIN_GROUP_ROWS
SPAN = fx.FIXTURE_REQUEST_SPAN_NS

_ACTIVITY_CASE = "CASE event_type " + " ".join(
    f"WHEN '{k}' THEN '{v}'" for k, v in fx.EVENT_ACTIVITY.items()
) + " END"

_LABEL_CASE = "CASE activity " + " ".join(
    f"WHEN '{k}' THEN {v!r}::DOUBLE" for k, v in C.ACTIVITY_LABELS.items()
) + f" ELSE {C.DEFAULT_LABEL!r}::DOUBLE END"

ACC = f"""acc AS (
  SELECT user_id // {fx.USERS_PER_DEVICE} AS user_id,
         {_ACTIVITY_CASE} AS activity,
         epoch_us(ts) * 1000 AS ts_ns,
         value / 10.0::DOUBLE - 5.0::DOUBLE AS acc_x,
         (CAST(json_extract_string(props, '$.k') AS BIGINT) - 50) / 5.0::DOUBLE AS acc_y,
         ((event_id * 37) % 100 - 50) / 10.0::DOUBLE AS acc_z,
         event_id
  FROM events)"""

GATED = f"""gated AS (
  SELECT * FROM acc QUALIFY count(*) OVER (PARTITION BY user_id, activity) > {GATE})"""

SCANNED = f"""scanned AS (
  SELECT user_id, activity, ts_ns,
         lag(ts_ns) OVER (PARTITION BY user_id, activity ORDER BY ts_ns) AS prev_ts
  FROM {{src}}),
flagged AS (
  SELECT *, ts_ns - prev_ts AS delta,
         CAST(sum(CASE WHEN ts_ns - prev_ts > {GAP} THEN 1 ELSE 0 END)
              OVER (PARTITION BY user_id, activity ORDER BY ts_ns ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
              AS BIGINT) AS interval_id
  FROM scanned)"""

INTERVALS = f"""intervals AS (
  SELECT user_id, activity, interval_id, min(ts_ns) AS interval_start, max(ts_ns) AS interval_end,
         count(*) AS interval_rows, (max(ts_ns) - min(ts_ns)) // {WIN} AS n_windows
  FROM flagged GROUP BY user_id, activity, interval_id)"""

WINDOWS = f"""windows AS (
  SELECT user_id, activity, interval_id, interval_start, interval_end, n_windows,
         j AS window_index, interval_end + (j - 1) * {WIN} AS window_lo, interval_end + j * {WIN} AS window_hi
  FROM intervals, LATERAL (SELECT unnest(range(0, n_windows + 1)) AS j))"""

MEMBERS = """members AS (
  SELECT w.user_id, w.activity, w.interval_id, w.window_index, w.window_lo, w.window_hi,
         a.ts_ns, a.acc_x, a.acc_y, a.acc_z
  FROM windows w JOIN acc a
    ON a.user_id = w.user_id AND a.activity = w.activity AND a.ts_ns > w.window_lo AND a.ts_ns < w.window_hi)"""

# every window of an interval, counted from its start, joined with the readings of the half-open range
START_MEMBERS = f"""swindows AS (
  SELECT user_id, activity, interval_id, j AS window_index, interval_start + j * {WIN} AS window_lo,
         interval_start + (j + 1) * {WIN} AS window_hi, interval_end
  FROM intervals, LATERAL (SELECT unnest(range(0, n_windows + 1)) AS j)),
smembers AS (
  SELECT w.user_id, w.activity, w.interval_id, w.window_index, w.window_lo, w.window_hi,
         a.ts_ns, a.acc_x, a.acc_y, a.acc_z
  FROM swindows w JOIN acc a ON a.user_id = w.user_id AND a.activity = w.activity
   AND a.ts_ns >= w.window_lo AND a.ts_ns < w.window_hi AND a.ts_ns <= w.interval_end)"""

GKEY = "user_id, activity, interval_id, window_index, window_lo, window_hi"


def _feature_ctes(members: str = "members", gkey: str = GKEY, ts: str = "ts_ns") -> str:
    return f"""s1 AS (
  SELECT {gkey}, count(*) AS n_rows, count(DISTINCT {ts}) AS n_distinct_ts,
         avg(acc_x) AS mean_x, avg(acc_y) AS mean_y, avg(acc_z) AS mean_z,
         coalesce(var_samp(acc_x), 0.0) AS variance_x, coalesce(var_samp(acc_y), 0.0) AS variance_y,
         coalesce(var_samp(acc_z), 0.0) AS variance_z, max(acc_x) AS max_x, max(acc_y) AS max_y,
         max(acc_z) AS max_z,
         avg(sqrt(acc_x * acc_x + acc_y * acc_y + acc_z * acc_z)) AS resultant
  FROM {members} GROUP BY {gkey}),
m2 AS (
  SELECT m.*, s1.mean_x AS mx, s1.mean_y AS my, s1.mean_z AS mz, s1.max_y AS max_y
  FROM {members} m JOIN s1 USING ({gkey})),
s2 AS (
  SELECT {gkey}, avg(abs(acc_x - mx)) AS avg_abs_diff_x, avg(abs(acc_y - my)) AS avg_abs_diff_y,
         avg(abs(acc_z - mz)) AS avg_abs_diff_z
  FROM m2 GROUP BY {gkey}),
pk AS (
  SELECT {gkey}, {ts} AS pts,
         {ts} - lag({ts}) OVER (PARTITION BY {gkey} ORDER BY {ts}) AS d
  FROM m2 WHERE trunc(acc_y) > {C.PEAK_FRACTION!r}::DOUBLE * max_y),
pg AS (
  SELECT {gkey}, count(*) AS n_pk,
         CAST(sum(CASE WHEN d > 0 THEN d END) AS DOUBLE) / count(CASE WHEN d > 0 THEN 1 END) AS g
  FROM pk GROUP BY {gkey}),
feat AS (
  SELECT s1.*, s2.avg_abs_diff_x, s2.avg_abs_diff_y, s2.avg_abs_diff_z,
         CASE WHEN pg.n_pk > 1 THEN coalesce(pg.g, 0.0) ELSE 0.0 END::DOUBLE AS avg_time_peak_y
  FROM s1 JOIN s2 USING ({gkey}) LEFT JOIN pg USING ({gkey}))"""


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes)


def motion_prefix(gated: bool = True) -> str:
    src = "gated" if gated else "acc"
    return with_ctes(ACC, GATED, SCANNED.format(src=src), INTERVALS, WINDOWS, MEMBERS)


