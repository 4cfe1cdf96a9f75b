"""The two jobs of the original application as Spark jobs, plus a small CLI.

``train``   labelled readings -> features -> labels -> split -> RF / DT -> model
            directory + test error (the batch training job).
``score``   request messages + live readings -> predictions and dead letters
            (one bulk job for a batch of requests).
``serve``   the same as a Structured Streaming query that also advances the
            progress state (the live consumer service).

    python -m stride.plans.jobs train --labelled PATH --model PATH [--kind rf|dt]
    python -m stride.plans.jobs score --requests PATH --live PATH --model PATH --out PATH
    python -m stride.plans.jobs serve --requests PATH --live PATH --model PATH --out PATH --checkpoint PATH
        [--format kafka --option kafka.bootstrap.servers=HOST:PORT --option subscribe=TOPIC]
"""

from __future__ import annotations

import argparse
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession

from .. import config as C
from ..operators import model as ml
from ..operators import requests as rq
from ..session import materialize
from ..sources import tables
from ..streaming import progress as sprog
from ..streaming import scoring as sscore
from .motion import motion_plan



@dataclass
class TrainResult:
    model: object
    model_path: str
    test_error: DataFrame  # one row: n_test, test_error
    sample_size: int
    rejected: int  # readings with a missing column, left out


def train(labelled: DataFrame, model_path: str, kind: str = "rf", params: C.MotionParams | None = None,
          users: list | None = None, activities: list | None = None, seed: int = 0,
          rejected_path: str | None = None) -> TrainResult:
    """Features of every window of every selected series, then fit, save and evaluate.

    Readings with a missing column are counted in the pass that reads them and,
    with ``rejected_path``, written there.
    """
    counted = Observation("readings")
    plan = motion_plan(labelled, params, users=users, activities=activities, counted=counted)
    rows = materialize(plan.labelled_features(), "training-rows")
    keys = (params or C.MotionParams()).keys
    train_rows, test_rows = ml.train_test(rows, [*keys, "interval_id", "window_index"], seed=seed)
    model = ml.fit(train_rows, kind)
    ml.save_model(model, model_path)
    err = ml.test_error(ml.predict(model, test_rows))
    if rejected_path:
        plan.rejected.write.mode("overwrite").parquet(rejected_path)
    return TrainResult(model, model_path, err, rows.count(), counted.get["n_rejected"])


def score(messages: DataFrame, live: DataFrame, model, bucket_ns: int = rq.REQUEST_BUCKET_NS):
    """(predictions, dead letters) for a batch of request messages."""
    return sscore.score_batch(messages, live, model, bucket_ns)


def serve(spark: SparkSession, requests: DataFrame, read_live: Callable[[], DataFrame], model_path: str, out_dir: str,
          checkpoint: str, progress_history: DataFrame | None = None, kind: str = "rf",
          stored_scores: DataFrame | None = None, trigger: dict | None = None, compact_every: int = 50):
    """Start the live service: one query that scores requests and advances the progress behind them.

    ``read_live`` is called in every micro-batch, so readings that arrived
    since are found.  A restart with the same ``checkpoint`` and ``out_dir``
    goes on where the last run stopped; a batch that was cut off is done again
    and replaces its own output.
    """
    model = ml.load_model(model_path, kind)  # once, not per request
    sprog.start_state(spark, f"{out_dir}/progress", progress_history, stored_scores)
    return (requests.writeStream.option("checkpointLocation", checkpoint)
            .foreachBatch(sscore.service_writer(read_live, model, out_dir, compact_every=compact_every))
            .trigger(**(trigger or {"processingTime": "1 second"})).start())


def _main() -> None:
    ap = argparse.ArgumentParser(prog="stride")
    sub = ap.add_subparsers(dest="cmd", required=True)
    t = sub.add_parser("train")
    t.add_argument("--labelled", required=True)
    t.add_argument("--format", default="parquet")
    t.add_argument("--column", action="append", default=[], metavar="OURS=THEIRS", help="column that has another name")
    t.add_argument("--rejected", help="folder for readings with a missing column")
    t.add_argument("--time-unit", default="ns", choices=list(tables.TIME_UNITS))
    t.add_argument("--model", required=True)
    t.add_argument("--kind", default="rf", choices=["rf", "dt"])
    t.add_argument("--users", type=int, nargs="*")
    t.add_argument("--gap-ns", type=int, default=C.GAP_NS)
    t.add_argument("--window-ns", type=int, default=C.WINDOW_NS)
    t.add_argument("--min-rows", type=int, default=C.MIN_GROUP_ROWS)
    for name in ("score", "serve"):
        s = sub.add_parser(name)
        s.add_argument("--requests", help="folder of request messages (not for a message bus)")
        s.add_argument("--format", default="parquet", help="format of the requests")
        s.add_argument("--option", action="append", default=[], metavar="KEY=VALUE", help="source option of the requests")
        s.add_argument("--live", required=True)
        s.add_argument("--live-format", default="parquet")
        s.add_argument("--live-column", action="append", default=[], metavar="OURS=THEIRS", help="live column that has another name")
        s.add_argument("--live-time-unit", default="ns", choices=list(tables.TIME_UNITS))
        s.add_argument("--model", required=True)
        s.add_argument("--kind", default="rf", choices=["rf", "dt"])
        s.add_argument("--out", required=True)
        if name == "serve":
            s.add_argument("--checkpoint", required=True, help="folder that keeps offsets across restarts")
            s.add_argument("--progress")
            s.add_argument("--scores")
    a = ap.parse_args()
    spark = SparkSession.builder.appName(f"stride-{a.cmd}").getOrCreate()
    if a.cmd == "train":
        params = C.MotionParams(gap_ns=a.gap_ns, window_ns=a.window_ns, min_rows=a.min_rows)
        labelled = tables.read_labelled(spark, a.labelled, a.format, columns=dict(o.split("=", 1) for o in a.column),
                                        time_unit=a.time_unit)
        r = train(labelled, a.model, a.kind, params=params, users=a.users, rejected_path=a.rejected)
        print("sample size", r.sample_size, "rejected readings", r.rejected)
        r.test_error.show()
        return
    options = dict(o.split("=", 1) for o in a.option)

    def read_live() -> DataFrame:
        return tables.read_live(spark, a.live, a.live_format, columns=dict(o.split("=", 1) for o in a.live_column),
                                time_unit=a.live_time_unit)

    if a.cmd == "score":
        messages = spark.read.format(a.format).options(**options).load(a.requests)
        results, dead = score(messages, read_live(), ml.load_model(a.model, a.kind))
        results.write.mode("overwrite").parquet(f"{a.out}/results")
        dead.write.mode("overwrite").parquet(f"{a.out}/dead")
        return
    hist = tables.read_progress(spark, a.progress) if a.progress else None
    scores = tables.read_scores(spark, a.scores) if a.scores else None
    serve(spark, tables.read_requests_stream(spark, a.requests, a.format, options), read_live, a.model, a.out,
          a.checkpoint, hist, a.kind, stored_scores=scores)
    spark.streams.awaitAnyTermination()


if __name__ == "__main__":
    _main()
