"""Registered queries over the driver's tables, each with its DuckDB oracle.

Every query reads the whole ``events`` table (through the fixture mapping of
``sources.fixtures``), so its work grows with the table.  Doubles keep nine
significant digits on both sides: see ``SCALE``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import config as C
from ..functions.scalar import activity_label, java_long, perfect_number
from ..operators import forest_table
from ..operators import model as ml
from ..operators import progress as prog
from ..operators import requests as rq
from ..operators import series
from ..sources import fixtures as fx
from ..sources import series_store
from . import oracle as O
from ..session import materialize, scratch_path
from . import saved_models
from .motion import motion_plan

FIXTURE_PARAMS = C.MotionParams(gap_ns=fx.FIXTURE_GAP_NS, window_ns=fx.FIXTURE_WINDOW_NS,
                                min_rows=C.MIN_GROUP_ROWS)
GKEY = ["user_id", "activity", "interval_id", "window_index", "window_lo", "window_hi"]
UNLABELLED = "Jogging"
SPLIT_KEY = ["user_id", "activity", "interval_id", "window_index"]


# Oracle hygiene for the value hash.  The engines agree to ~1e-15 relative,
# but many exact results are short decimals sitting exactly on a rounding tie
# (means and variances over 2^k readings), where that noise picks the side.
# Both sides therefore shift and scale by numbers whose digits never end (so no
# short decimal stays on a tie, and sums that cancel to nothing look alike) and
# keep nine significant digits of every double.
SCALE = 1.0 + 1.7320508075688772e-12
SHIFT = 1.7320508075688772e-06


def round_col(c: F.Column) -> F.Column:
    text = F.format_string("%.8e", (c + F.lit(SHIFT)) * F.lit(SCALE))
    return F.when(c.isNull(), F.lit(None).cast("double")).otherwise(text.try_cast("double") + F.lit(0.0))


def rounded(df: DataFrame) -> DataFrame:
    return df.select(*[
        round_col(F.col(f.name)).alias(f.name) if isinstance(f.dataType, T.DoubleType) else F.col(f.name)
        for f in df.schema.fields
    ])


def round_sql(expr: str) -> str:
    return f"(CAST(printf('%.8e', (({expr}) + {SHIFT!r}::DOUBLE) * {SCALE!r}::DOUBLE) AS DOUBLE) + 0.0)"


def _ev(spark: SparkSession, d: str) -> DataFrame:
    return fx.events(spark, d)


def _plan(spark: SparkSession, d: str):
    return motion_plan(fx.labelled(_ev(spark, d)), FIXTURE_PARAMS)


def _scanned_gated(spark, d):
    p = _plan(spark, d)
    return p.scanned().filter(F.col("key_rows") > F.lit(FIXTURE_PARAMS.min_rows))


# ---------------------------------------------------------------- Spark side

def q_accel_scan(spark, d):
    return fx.labelled(_ev(spark, d)).withColumn("trunc_y", java_long("acc_y"))


def q_live_scan(spark, d):
    return fx.live(_ev(spark, d)).withColumn("trunc_y", java_long("y"))


def q_group_gate(spark, d):
    return series.group_gate(fx.labelled(_ev(spark, d)), ["user_id", "activity"], C.MIN_GROUP_ROWS)


def q_series_bounds(spark, d):
    return series.series_bounds(fx.labelled(_ev(spark, d)), ["user_id", "activity"], "ts_ns")


def q_gap_deltas(spark, d):
    return series.gap_deltas(_scanned_gated(spark, d), ["user_id", "activity"], "ts_ns")


def q_jumps(spark, d):
    return series.jumps(_scanned_gated(spark, d), ["user_id", "activity"], "ts_ns")


def q_jump_boundaries(spark, d):
    return series.jump_boundaries(q_jumps(spark, d), ["user_id", "activity"])


def q_intervals(spark, d):
    return _plan(spark, d).intervals()


def _stored_plan(spark, d):
    """The readings written as a bucketed, sorted table, and the plan over it."""
    table = f"readings_{uuid.uuid4().hex[:12]}"
    series_store.write(fx.labelled(_ev(spark, d)), table, scratch_path(spark, table), FIXTURE_PARAMS, files=8)
    return motion_plan(series_store.read(spark, table, FIXTURE_PARAMS), FIXTURE_PARAMS)


def q_intervals_stored(spark, d):
    return _stored_plan(spark, d).intervals()


def q_windows_end(spark, d):
    return _plan(spark, d).windows().select(*GKEY)


def q_window_members(spark, d):
    return _plan(spark, d).members().select("user_id", "activity", "interval_id", "window_index", "ts_ns")


def q_feat_mean(spark, d):
    return _plan(spark, d).moments().select(*GKEY, "n_rows", "mean_x", "mean_y", "mean_z")


def q_feat_variance(spark, d):
    return _plan(spark, d).moments().select(*GKEY, "variance_x", "variance_y", "variance_z")


def q_feat_max(spark, d):
    return _plan(spark, d).moments().select(*GKEY, "max_x", "max_y", "max_z")


def q_feat_resultant(spark, d):
    return _plan(spark, d).moments().select(*GKEY, "resultant")


def q_feat_abs_dev(spark, d):
    return _plan(spark, d).second_pass().select(*GKEY, "avg_abs_diff_x", "avg_abs_diff_y", "avg_abs_diff_z")


def q_feat_peak_gap(spark, d):
    return _plan(spark, d).second_pass().select(*GKEY, "avg_time_peak_y")


def q_features(spark, d):
    return _plan(spark, d).features()


def q_labelled_features(spark, d):
    return _plan(spark, d).labelled_features()


def q_windows_start(spark, d):
    return _plan(spark, d).start_windows()


def q_features_start(spark, d):
    return _plan(spark, d).start_features()


def q_labelled_strict(spark, d):
    """One activity is renamed to a name no label has; its windows go."""
    lab = fx.labelled(_ev(spark, d))
    renamed = lab.withColumn("activity", F.when(F.col("activity") == UNLABELLED, F.lit("Cycling")).otherwise(F.col("activity")))
    return motion_plan(renamed, FIXTURE_PARAMS).labelled_features(anchor="start", strict=True)


def q_perfect_number(spark, d):
    f = _plan(spark, d).features()
    return f.select(*GKEY, perfect_number().alias("perfect_number"))


def q_train_test_split(spark, d):
    lf = _plan(spark, d).labelled_features()
    part = F.when(ml.split_flag(SPLIT_KEY), F.lit("train")).otherwise(F.lit("test"))
    return lf.groupBy(part.alias("part"), "label").agg(F.count(F.lit(1)).alias("n_rows"))


def _messages(spark, d):
    # Materialise the fixture messages (a written table in the shared folder):
    # downstream the parser then sees a plain column, as it would from a
    # message source, instead of inlining the seven-shape generator
    # expression into every reference.
    return materialize(fx.requests(_ev(spark, d)), "request-messages")


def _requests(spark, d):
    return rq.parse_requests(_messages(spark, d))


def q_requests_parsed(spark, d):
    return _requests(spark, d)[0]


def q_requests_dead(spark, d):
    return _requests(spark, d)[1]


def q_request_features(spark, d):
    parsed, _ = _requests(spark, d)
    return rq.request_features(parsed, fx.live(_ev(spark, d)))


def q_request_features_two_times(spark, d):
    """The live table's two time columns differ: ranges go by ``timestamp``, peaks are timed on ``timestamp_long``."""
    parsed, _ = _requests(spark, d)
    live = fx.live(_ev(spark, d)).withColumn("timestamp_long", F.col("timestamp_long") * 2 + 7)
    return rq.request_features(parsed, live)


def _moving(spark, d):
    lab = fx.labelled(_ev(spark, d), with_event_id=True).withColumn("label", activity_label("activity"))
    return lab.filter(F.col("label").isin(*C.MOVING_LABELS))


def q_moving_gate(spark, d):
    return _moving(spark, d).select("user_id", "activity", "ts_ns", "event_id", "label")


def q_progress_latest(spark, d):
    return prog.latest_progress(fx.progress_history(_ev(spark, d)))


def _progress_events(spark, d):
    ev = _ev(spark, d)
    lab = fx.labelled(ev, with_event_id=True).withColumn("label", activity_label("activity"))
    mv = lab.filter(F.col("label").isin(*C.MOVING_LABELS))
    uid = F.concat(F.lit(fx.UUID_PREFIX), F.lpad(F.col("user_id").cast("string"), 12, "0"))
    return mv.select(uid.alias("user_id"), "event_id", "ts_ns",
                     ((F.col("acc_x") + F.col("acc_y") + F.col("acc_z")) / F.lit(C.SCORE_DIVISOR)).alias("score"))


def q_progress_states(spark, d):
    start = prog.latest_progress(fx.progress_history(_ev(spark, d)))
    st = prog.progress_states(_progress_events(spark, d), start, None)
    return st.select("user_id", "event_id", "ts_ns", "k", "score", "progress", "saved", "published",
                     "published_value")


def q_published_numbers(spark, d):
    start = prog.latest_progress(fx.progress_history(_ev(spark, d)))
    st = prog.progress_states(_progress_events(spark, d), start, None)
    return prog.published_rows(st)


# ---- machine learning: the saved models are applied (their trees are the oracle); fits are checked by invariants

def _train_test(spark, d):
    # the labelled feature rows feed several passes (tree training) and the
    # test predictions: cut the lineage once with a reliable checkpoint in the
    # shared folder instead of re-running the feature plan for each
    lf = materialize(_plan(spark, d).labelled_features(), "labelled-features")
    return ml.train_test(lf, SPLIT_KEY)


def _predictions(spark, d, kind):
    _, test = _train_test(spark, d)
    return ml.predict(saved_models.load(spark, kind), test).select(*GKEY, "label", "prediction")


def q_rf_predictions(spark, d):
    return _predictions(spark, d, "rf")


def q_dt_predictions(spark, d):
    return _predictions(spark, d, "dt")


def q_rf_test_error(spark, d):
    return ml.test_error(_predictions(spark, d, "rf"))


def q_dt_test_error(spark, d):
    return ml.test_error(_predictions(spark, d, "dt"))


def _fitted(spark, d, kind):
    """(train rows, test rows, model fitted on all training rows, folder it is saved in)"""
    train, test = _train_test(spark, d)
    model = ml.fit(train, kind)
    return train, test, model, ml.save_model(model, scratch_path(spark, f"fit-{kind}"))


def _fit_check(spark, d, kind):
    """Fit on all training rows: size, classes, trees, depth, and answers that differ after a reload, after a second fit and from the nodes' table."""
    train, test, first, path = _fitted(spark, d, kind)
    models = first, ml.load_model(path, kind), ml.fit(train, kind), forest_table.load(spark, path)
    key = ["user_id", "activity", "interval_id", "window_index"]
    rows = [ml.predict(m, test).select(*key, F.col("prediction").alias(f"p{i}")) for i, m in enumerate(models)]
    both = rows[0].join(rows[1], key).join(rows[2], key).join(rows[3], key)
    trees = getattr(first, "trees", [first])
    differ = lambda a, b: F.coalesce(F.sum((F.col(a) != F.col(b)).cast("bigint")), F.lit(0))
    counts = both.agg(F.count(F.lit(1)).alias("n_test"), differ("p0", "p1").alias("n_reload"), differ("p0", "p2").alias("n_refit"),
                      differ("p0", "p3").alias("n_table"))
    return counts.crossJoin(train.agg(F.count(F.lit(1)).alias("n_train"))).select(  # two rows of one value each
        "n_train", "n_test", F.lit(first.numClasses).alias("n_classes"), F.lit(len(trees)).alias("n_trees"),
        F.lit(max(t.depth for t in trees) <= C.RF_MAX_DEPTH).alias("depth_ok"), "n_reload", "n_refit", "n_table")


def _fitted_error(spark, d, kind):
    """The test error of the model just fitted, by transform and by its table of nodes, per label and in all (label null)."""
    _, test, model, path = _fitted(spark, d, kind)
    key = ["user_id", "activity", "interval_id", "window_index"]
    table = ml.predict(forest_table.load(spark, path), test).select(*key, F.col("prediction").alias("by_table"))
    rows = ml.predict(model, test).select(*key, "label", "prediction").join(table, key)
    wrong = lambda c: F.avg((F.col(c) != F.col("label")).cast("double"))
    return rows.rollup("label").agg(F.count(F.lit(1)).alias("n_test"), wrong("prediction").alias("test_error"),
                                    wrong("by_table").alias("table_error"))


def q_rf_fitted_error(spark, d):
    return _fitted_error(spark, d, "rf")


def q_dt_fitted_error(spark, d):
    return _fitted_error(spark, d, "dt")


def q_rf_fit_check(spark, d):
    return _fit_check(spark, d, "rf")


def q_dt_fit_check(spark, d):
    return _fit_check(spark, d, "dt")


def q_request_predictions(spark, d):
    parsed, _ = _requests(spark, d)
    f = rq.request_features(parsed, fx.live(_ev(spark, d)))
    return ml.predict(saved_models.load(spark, "rf"), f).select(
        "request_id", "user_id", "start_ts", "finish_ts", "n_rows", "prediction")


def q_progress_from_zero(spark, d):
    st = prog.progress_states(_progress_events(spark, d), None, None)
    return st.select("user_id", "event_id", "ts_ns", "k", "score", "progress", "saved", "published", "published_value")


def q_published_with_stored_scores(spark, d):
    ev = _ev(spark, d)
    start = prog.latest_progress(fx.progress_history(ev, fx.HISTORY_EVERY))
    return prog.published_rows(prog.progress_states(_progress_events(spark, d), start, fx.stored_scores(ev)))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "accel_scan": q_accel_scan,
    "live_scan": q_live_scan,
    "group_gate": q_group_gate,
    "series_bounds": q_series_bounds,
    "gap_deltas": q_gap_deltas,
    "jumps": q_jumps,
    "jump_boundaries": q_jump_boundaries,
    "intervals": q_intervals,
    "intervals_stored": q_intervals_stored,
    "windows_end": q_windows_end,
    "window_members": q_window_members,
    "feat_mean": q_feat_mean,
    "feat_variance": q_feat_variance,
    "feat_max": q_feat_max,
    "feat_resultant": q_feat_resultant,
    "feat_abs_dev": q_feat_abs_dev,
    "feat_peak_gap": q_feat_peak_gap,
    "features": q_features,
    "labelled_features": q_labelled_features,
    "windows_start": q_windows_start,
    "features_start": q_features_start,
    "labelled_strict": q_labelled_strict,
    "perfect_number": q_perfect_number,
    "train_test_split": q_train_test_split,
    "requests_parsed": q_requests_parsed,
    "requests_dead": q_requests_dead,
    "request_features": q_request_features,
    "request_features_two_times": q_request_features_two_times,
    "moving_gate": q_moving_gate,
    "progress_latest": q_progress_latest,
    "progress_states": q_progress_states,
    "published_numbers": q_published_numbers,
    "progress_from_zero": q_progress_from_zero,
    "published_with_stored_scores": q_published_with_stored_scores,
    "rf_fit_check": q_rf_fit_check,
    "dt_fit_check": q_dt_fit_check,
    "rf_fitted_error": q_rf_fitted_error,
    "dt_fitted_error": q_dt_fitted_error,
    "rf_predictions": q_rf_predictions,
    "dt_predictions": q_dt_predictions,
    "rf_test_error": q_rf_test_error,
    "dt_test_error": q_dt_test_error,
    "request_predictions": q_request_predictions,
}


def _stream_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    from . import streams

    return {
        "stream_progress": streams.q_stream_progress,
        "stream_published": streams.q_stream_published,
        "stream_progress_latest": streams.q_stream_progress_latest,
        "stream_scores": streams.q_stream_scores,
        "stream_scoring": streams.q_stream_scoring,
        "stream_dead_letters": streams.q_stream_dead_letters,
    }


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    allq = {**QUERIES, **_stream_queries()}
    return {k: (lambda f: (lambda spark, d: rounded(f(spark, d))))(f) for k, f in allq.items()}


# ---------------------------------------------------------------- oracle side

def _r(cols: list[str]) -> str:
    return ", ".join(f"{round_sql(c)} AS {c}" for c in cols)


AXES_R = _r(["acc_x", "acc_y", "acc_z"])
MOTION = O.motion_prefix()
FEAT = MOTION + ",\n" + O._feature_ctes()
G = O.GKEY
START = MOTION + ",\n" + O.START_MEMBERS
START_FEAT = START + ",\n" + O._feature_ctes("smembers")
DEVICE_UUID = f"'{fx.UUID_PREFIX}' || lpad(CAST(user_id // {fx.USERS_PER_DEVICE} AS VARCHAR), 12, '0')"
TS_NS = "epoch_us(ts) * 1000"

REQ = f"""req AS (
  SELECT event_id AS request_id, {TS_NS} AS request_ts,
    CASE event_id % {fx.REQUEST_SHAPES}
      WHEN 0 THEN u || ',' || t
      WHEN 1 THEN ''
      WHEN 2 THEN u || ',abc,' || t
      WHEN 3 THEN 'not-a-uuid,' || t0 || ',' || t
      WHEN 4 THEN u || ',' || t || ',' || t0 || ',extra'
      WHEN 5 THEN u || ',' || t0 || ',' || t || ',extra'
      ELSE u || ',' || t0 || ',' || t END AS value
  FROM (SELECT *, {DEVICE_UUID} AS u, CAST({TS_NS} AS VARCHAR) AS t,
               CAST({TS_NS} - {O.SPAN} AS VARCHAR) AS t0 FROM events)),
cls AS (
  SELECT *, string_split(value, ',') AS parts FROM req),
cls2 AS (
  SELECT *, CASE
      WHEN length(value) = 0 THEN 'empty'
      WHEN len(parts) <= 2 THEN 'too_few_fields'
      WHEN NOT (regexp_matches(parts[2], '{C.LONG_PATTERN}') AND regexp_matches(parts[3], '{C.LONG_PATTERN}'))
        THEN 'bad_number'
      WHEN TRY_CAST(parts[2] AS BIGINT) IS NULL OR TRY_CAST(parts[3] AS BIGINT) IS NULL THEN 'bad_number'
    END AS dead_reason
  FROM cls),
parsed AS (
  SELECT request_id, request_ts, parts[1] AS user_text,
         coalesce(regexp_matches(parts[1], '{C.UUID_PATTERN}'), false) AS valid_user,
         CASE WHEN regexp_matches(parts[1], '{C.UUID_PATTERN}') THEN
           lower(right('00000000' || split_part(parts[1], '-', 1), 8) || '-' || right('0000' || split_part(parts[1], '-', 2), 4)
                 || '-' || right('0000' || split_part(parts[1], '-', 3), 4) || '-' || right('0000' || split_part(parts[1], '-', 4), 4)
                 || '-' || right('000000000000' || split_part(parts[1], '-', 5), 12))
         END AS user_id,
         CAST(parts[2] AS BIGINT) AS start_ts, CAST(parts[3] AS BIGINT) AS finish_ts
  FROM cls2 WHERE dead_reason IS NULL)"""

LIVE = f"""live AS (
  SELECT {DEVICE_UUID} AS user_id, {TS_NS} AS ts_ns,
         value / 10.0::DOUBLE - 5.0::DOUBLE AS acc_x,
         (CAST(json_extract_string(props, '$.k') AS BIGINT) - 50) / 5.0::DOUBLE AS acc_y,
         ((event_id * 37) % 100 - 50) / 10.0::DOUBLE AS acc_z
  FROM events)"""

REQ_MEMBERS = """rmembers AS (
  SELECT v.request_id, l.ts_ns, l.acc_x, l.acc_y, l.acc_z
  FROM parsed v JOIN live l
    ON v.valid_user AND v.start_ts <= v.finish_ts AND l.user_id = v.user_id
   AND l.ts_ns >= v.start_ts AND l.ts_ns <= v.finish_ts)"""

def _hist(where: str = "") -> str:
    return f"""hist AS (
  SELECT {DEVICE_UUID} AS user_id,
         CAST({fx.PROGRESS_BASE} + event_id % {fx.PROGRESS_SPREAD} AS INTEGER) AS walking_progress,
         epoch_us(ts) // 1000 AS timestamp
  FROM events WHERE event_type = '{fx.PROGRESS_EVENT}' {where}),
latest AS (
  SELECT user_id, arg_max(walking_progress, timestamp) AS walking_progress, max(timestamp) AS timestamp
  FROM hist GROUP BY user_id)"""


HIST = _hist()
PRIOR = f"""SELECT {DEVICE_UUID} AS user_id, sum(value / 10.0::DOUBLE) AS psum, count(*) AS pn FROM events
  WHERE event_type = '{fx.SCORE_EVENT}' AND (user_id // {fx.USERS_PER_DEVICE}) % 2 = 1 GROUP BY ALL"""
NO_PRIOR = "SELECT '' AS user_id, 0.0::DOUBLE AS psum, CAST(0 AS BIGINT) AS pn WHERE false"
PART = f"AND (user_id // {fx.USERS_PER_DEVICE}) % {fx.HISTORY_EVERY} = 0"

_MOVING_IN = ", ".join(f"{v!r}::DOUBLE" for v in C.MOVING_LABELS)
P = C.ProgressParams()
_R = f"(CASE WHEN s.p < {P.full} THEN (CASE WHEN s.p >= {P.snap_from} THEN {P.full} ELSE s.p + {P.step} END) ELSE s.p END)"
_SAVED = f"({_R} < {P.full})"
_TOT = f"(s.tot + CASE WHEN {_SAVED} THEN m.score ELSE 0.0::DOUBLE END)"
_CNT = f"(s.cnt + CASE WHEN {_SAVED} THEN 1 ELSE 0 END)"
_PUB = f"({_R} > {P.publish_above} AND {_R} <= {P.full})"

# step-by-step simulation of the three calls per moving event (recursive CTE):
# an independent check of the closed form used on the Spark side
def progress_sim(hist: str, prior: str = NO_PRIOR) -> str:
    return f"""WITH RECURSIVE {O.ACC},
{hist},
prior AS ({prior}),
mv AS (
  SELECT '{fx.UUID_PREFIX}' || lpad(CAST(user_id AS VARCHAR), 12, '0') AS user_id, event_id, ts_ns,
         (acc_x + acc_y + acc_z) / {C.SCORE_DIVISOR!r}::DOUBLE AS score,
         row_number() OVER (PARTITION BY user_id ORDER BY ts_ns, event_id) AS k
  FROM acc WHERE {O._LABEL_CASE} IN ({_MOVING_IN})),
users AS (
  SELECT DISTINCT mv.user_id, CAST(coalesce(l.walking_progress, 0) AS BIGINT) AS p0,
         coalesce(q.psum, 0.0)::DOUBLE AS psum, CAST(coalesce(q.pn, 0) AS BIGINT) AS pn
  FROM mv LEFT JOIN latest l USING (user_id) LEFT JOIN prior q USING (user_id)),
st AS (
  SELECT user_id, CAST(0 AS BIGINT) AS k, p0 AS p, psum AS tot, pn AS cnt,
         CAST(NULL AS BIGINT) AS event_id, CAST(NULL AS BIGINT) AS ts_ns, CAST(NULL AS DOUBLE) AS score,
         CAST(NULL AS BOOLEAN) AS saved, CAST(NULL AS BOOLEAN) AS published, CAST(NULL AS DOUBLE) AS pval
  FROM users
  UNION ALL
  SELECT s.user_id, m.k,
         CASE WHEN {_PUB} THEN {P.full} ELSE {_R} END AS p,
         {_TOT} AS tot, {_CNT} AS cnt, m.event_id, m.ts_ns, m.score,
         {_SAVED} AS saved, {_PUB} AS published,
         CASE WHEN {_PUB} THEN (CASE WHEN {_CNT} > 0 THEN {_TOT} / {_CNT} ELSE 0.0::DOUBLE END) END AS pval
  FROM st s JOIN mv m ON m.user_id = s.user_id AND m.k = s.k + 1)"""


PROGRESS_SIM = progress_sim(HIST)
PART_SIM = progress_sim(_hist(PART), PRIOR)
ZERO_SIM = progress_sim(_hist("AND false"))


def _sel(cols: list[str], doubles: list[str], frm: str) -> str:
    parts = [c if c not in doubles else f"{round_sql(c)} AS {c}" for c in cols]
    return f"SELECT {', '.join(parts)} FROM {frm}"


F11 = list(C.FEATURE_COLUMNS)
STATES = f"""\nSELECT user_id, event_id, ts_ns, k, {round_sql('score')} AS score,
        CAST(p AS INTEGER) AS progress, saved, published, {round_sql('pval')} AS published_value
        FROM st WHERE k > 0"""
PUBLISHED = f"""\nSELECT user_id, ts_ns // 1000000 AS "timestamp", ts_ns // 1000000 AS timestamp_long,
        {', '.join(f'{round_sql("0.0::DOUBLE")} AS {c}' for c in F11)}, {round_sql('pval')} AS perfect_number
        FROM st WHERE k > 0 AND published"""
IN_TRAIN = f"""((('0x' || substr(md5(concat_ws('|', '0', user_id, activity, interval_id, window_index)), 1, 8))::BIGINT % 1000)
        < {int(round(C.SPLIT_WEIGHTS[0] / sum(C.SPLIT_WEIGHTS) * 1000))})"""
REQUEST_FEATURES = "WITH " + REQ + ",\n" + LIVE + ",\n" + REQ_MEMBERS + ",\n" + O._feature_ctes("rmembers", "request_id", "ts_ns")

ORACLE: dict[str, str] = {
    "accel_scan": f"WITH {O.ACC}\nSELECT user_id, activity, ts_ns, {AXES_R}, CAST(trunc(acc_y) AS BIGINT) AS trunc_y FROM acc",
    "live_scan": f"""SELECT {DEVICE_UUID} AS user_id, {TS_NS} AS "timestamp", {TS_NS} AS timestamp_long,
        {round_sql('value / 10.0::DOUBLE - 5.0::DOUBLE')} AS x,
        {round_sql("(CAST(json_extract_string(props, '$.k') AS BIGINT) - 50) / 5.0::DOUBLE")} AS y,
        {round_sql('((event_id * 37) % 100 - 50) / 10.0::DOUBLE')} AS z,
        CAST(trunc((CAST(json_extract_string(props, '$.k') AS BIGINT) - 50) / 5.0::DOUBLE) AS BIGINT) AS trunc_y
        FROM events""",
    "group_gate": f"WITH {O.ACC}\nSELECT user_id, activity, count(*) AS n_rows, count(*) > {O.GATE} AS passes "
                  "FROM acc GROUP BY user_id, activity",
    "series_bounds": f"WITH {O.ACC}\nSELECT user_id, activity, min(ts_ns) AS first_ts, max(ts_ns) AS last_ts, "
                     "count(*) AS n_rows FROM acc GROUP BY user_id, activity",
    "gap_deltas": MOTION + "\nSELECT user_id, activity, ts_ns, prev_ts, delta FROM flagged WHERE prev_ts IS NOT NULL",
    "jumps": MOTION + f"\nSELECT user_id, activity, prev_ts AS before_ts, ts_ns AS after_ts, delta FROM flagged "
                      f"WHERE delta > {O.GAP}",
    "jump_boundaries": MOTION + f"""\nSELECT user_id, activity, unnest([prev_ts, ts_ns]) AS boundary_ts
        FROM flagged WHERE delta > {O.GAP}""",
    "intervals": MOTION + "\nSELECT user_id, activity, interval_id, interval_start, interval_end, interval_rows, "
                          "n_windows FROM intervals",
    "windows_end": MOTION + f"\nSELECT {G} FROM windows",
    "window_members": MOTION + "\nSELECT user_id, activity, interval_id, window_index, ts_ns FROM members",
    "feat_mean": FEAT + "\n" + _sel([G, "n_rows", "mean_x", "mean_y", "mean_z"], ["mean_x", "mean_y", "mean_z"], "s1"),
    "feat_variance": FEAT + "\n" + _sel([G, "variance_x", "variance_y", "variance_z"],
                                        ["variance_x", "variance_y", "variance_z"], "s1"),
    "feat_max": FEAT + "\n" + _sel([G, "max_x", "max_y", "max_z"], ["max_x", "max_y", "max_z"], "s1"),
    "feat_resultant": FEAT + "\n" + _sel([G, "resultant"], ["resultant"], "s1"),
    "feat_abs_dev": FEAT + "\n" + _sel([G, "avg_abs_diff_x", "avg_abs_diff_y", "avg_abs_diff_z"],
                                       ["avg_abs_diff_x", "avg_abs_diff_y", "avg_abs_diff_z"], "feat"),
    "feat_peak_gap": FEAT + "\n" + _sel([G, "avg_time_peak_y"], ["avg_time_peak_y"], "feat"),
    "features": FEAT + "\n" + _sel([G, "n_rows", "n_distinct_ts", *F11], F11, "feat"),
    "labelled_features": FEAT + "\n" + _sel([G, "n_rows", "n_distinct_ts", *F11, f"{round_sql(O._LABEL_CASE)} AS label"], F11,
                                            "feat"),
    "windows_start": START + f"\nSELECT {G}, count(*) AS n_rows FROM smembers GROUP BY ALL",
    "features_start": START_FEAT + "\n" + _sel([G, "n_rows", "n_distinct_ts", *F11], F11, "feat"),
    "labelled_strict": START_FEAT + "\n" + _sel([G, "n_rows", "n_distinct_ts", *F11, f"{round_sql(O._LABEL_CASE)} AS label"], F11,
                                               f"feat WHERE activity <> '{UNLABELLED}'"),
    "perfect_number": FEAT + f"\nSELECT {G}, {round_sql('(' + ' + '.join(F11) + f') / {C.SCORE_DIVISOR!r}::DOUBLE')} "
                             "AS perfect_number FROM feat",
    "train_test_split": FEAT + f"""\nSELECT CASE WHEN (('0x' || substr(md5(concat_ws('|', '0', user_id, activity,
            interval_id, window_index)), 1, 8))::BIGINT % 1000) < {int(round(C.SPLIT_WEIGHTS[0] / sum(C.SPLIT_WEIGHTS) * 1000))}
            THEN 'train' ELSE 'test' END AS part, {round_sql(O._LABEL_CASE)} AS label, count(*) AS n_rows
        FROM feat GROUP BY ALL""",
    "requests_parsed": "WITH " + REQ + "\nSELECT * FROM parsed",
    "requests_dead": "WITH " + REQ + "\nSELECT request_id, request_ts, value, dead_reason FROM cls2 "
                                     "WHERE dead_reason IS NOT NULL",
    "request_features": "WITH " + REQ + ",\n" + LIVE + ",\n" + REQ_MEMBERS + ",\n"
        + O._feature_ctes("rmembers", "request_id", "ts_ns")
        + f"""\nSELECT p.*, coalesce(f.n_rows, 0) AS n_rows, coalesce(f.n_distinct_ts, 0) AS n_distinct_ts,
            {', '.join(f'{round_sql("f." + c)} AS {c}' for c in F11)}, coalesce(f.n_rows, 0) > 0 AS scored
            FROM parsed p LEFT JOIN feat f USING (request_id)""",
    "moving_gate": f"""WITH {O.ACC}, lab AS (SELECT *, {O._LABEL_CASE} AS label FROM acc)
        SELECT user_id, activity, ts_ns, event_id, {round_sql('label')} AS label FROM lab WHERE label IN ({_MOVING_IN})""",
    "progress_latest": "WITH " + HIST + "\nSELECT * FROM latest",
    "progress_states": PROGRESS_SIM + STATES,
    "published_numbers": PROGRESS_SIM + PUBLISHED,
    "published_with_stored_scores": PART_SIM + PUBLISHED,
    "progress_from_zero": ZERO_SIM + STATES,
    **{f"{k}_predictions": FEAT + f"""\nSELECT {G}, {round_sql(O._LABEL_CASE)} AS label, {round_sql('prediction')} AS prediction
        FROM {saved_models.prediction_sql(k, 'feat')} WHERE NOT {IN_TRAIN}""" for k in ("rf", "dt")},
    **{f"{k}_test_error": FEAT + f"""\nSELECT count(*) AS n_test, {round_sql(f'avg(CAST(prediction <> {O._LABEL_CASE} AS DOUBLE))')} AS test_error
        FROM {saved_models.prediction_sql(k, 'feat')} WHERE NOT {IN_TRAIN}""" for k in ("rf", "dt")},
    **{f"{k}_fit_check": FEAT + f"""\nSELECT count(*) FILTER ({IN_TRAIN}) AS n_train, count(*) FILTER (NOT {IN_TRAIN}) AS n_test,
        {C.NUM_CLASSES} AS n_classes, {n} AS n_trees, true AS depth_ok, CAST(0 AS BIGINT) AS n_reload, CAST(0 AS BIGINT) AS n_refit, CAST(0 AS BIGINT) AS n_table
        FROM feat""" for k, n in (("rf", C.RF_NUM_TREES), ("dt", 1))},
    "request_predictions": REQUEST_FEATURES + f"""\nSELECT request_id, user_id, start_ts, finish_ts, n_rows, {round_sql('prediction')} AS prediction
        FROM {saved_models.prediction_sql('rf', "(SELECT p.*, coalesce(f.n_rows, 0) AS n_rows, " + ', '.join('f.' + c for c in F11) + " FROM parsed p LEFT JOIN feat f USING (request_id))")}""",
}


ORACLE["intervals_stored"] = ORACLE["intervals"]
# the fixture's timestamp_long runs twice as fast
ORACLE["request_features_two_times"] = ORACLE["request_features"].replace(
    round_sql("f.avg_time_peak_y"), round_sql("2.0::DOUBLE * f.avg_time_peak_y"))

# stream twins: the stream must reproduce its batch query exactly
ORACLE["stream_progress"] = ORACLE["progress_states"]
ORACLE["stream_published"] = ORACLE["published_numbers"]
ORACLE["stream_dead_letters"] = ORACLE["requests_dead"]
ORACLE["stream_scoring"] = ORACLE["request_predictions"]
ORACLE["stream_progress_latest"] = PROGRESS_SIM + """
SELECT user_id, CAST(arg_max(p, k) AS INTEGER) AS walking_progress, max(ts_ns) // 1000000 AS "timestamp"
FROM st WHERE k > 0 GROUP BY user_id HAVING max(p) <= 100"""
ORACLE["stream_scores"] = PART_SIM + f"""
SELECT user_id, ts_ns // 1000000 AS "timestamp", {round_sql('score')} AS perfect_number FROM st WHERE k > 0 AND saved"""


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
