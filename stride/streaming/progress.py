"""Walking progress on a stream: one bulk step per micro-batch.

The state is a table of per-user rows (progress, sum and number of stored
scores, events seen), appended once per batch into ``state/batch_id=N``.  A
batch reads only versions below its own number, so a retried batch starts from
the same state and replaces its own output.  Stored progress and scores enter
once, as version -1, when the service first starts.

Every ``compact_every`` batches the versions are folded into one row per user,
and a pointer file, published in one step, names the last two folds.  A batch
opens the fold and the versions after it by name, so it reads a bounded number
of folders and lists none; versions older than the fold before the last are
dropped (a repeated batch may still need the last but one).

The outputs of a batch (states, scores, published rows, progress) count once its
commit record is written, after all of them: ``read_output`` shows whole batches.

Events advance with the bucketed closed form of ``operators.progress``: no
user's events meet in one task, and nothing of this package runs on executors.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as C
from ..operators import progress as prog
from ..sources import commits, sinks

STATE = "user_id string, progress bigint, psum double, pn bigint, seen bigint"


def start_state(spark: SparkSession, root: str, history: DataFrame | None = None,
                scores: DataFrame | None = None) -> None:
    """Write version -1 from the stored progress and scores; does nothing where the service has run before."""
    start = prog.latest_progress(history) if history is not None else spark.createDataFrame(
        [], "user_id string, walking_progress int")
    totals = prog.score_totals(scores) if scores is not None else spark.createDataFrame(
        [], "user_id string, _psum double, _pn bigint")
    both = start.select("user_id", "walking_progress").join(totals, "user_id", "full_outer").select(
        "user_id", F.coalesce("walking_progress", F.lit(0)).cast("bigint").alias("progress"),
        F.coalesce("_psum", F.lit(0.0)).alias("psum"), F.coalesce("_pn", F.lit(0)).cast("bigint").alias("pn"),
        F.lit(0).cast("bigint").alias("seen"))
    both.write.mode("ignore").parquet(f"{root}/folded/upto=-1")
    spark.createDataFrame([], STATE).write.mode("ignore").parquet(f"{root}/state/batch_id=-1")
    if commits.get(spark, f"{root}/folded/current") is None:
        commits.put(spark, f"{root}/folded/current", "-1")


def folds(spark: SparkSession, root: str) -> list[int]:
    """The last folds by number, oldest first: at most two."""
    return [int(n) for n in commits.get(spark, f"{root}/folded/current").split()]


def state_folders(spark: SparkSession, root: str, below: int) -> tuple[str, list[str]]:
    """The fold and the later versions that hold the state before batch ``below``."""
    upto = max(n for n in folds(spark, root) if n < below)
    return f"{root}/folded/upto={upto}", [f"{root}/state/batch_id={k}" for k in range(upto + 1, below)]


def read_state(spark: SparkSession, root: str, below: int) -> DataFrame:
    """Latest row per user among the versions before batch ``below``."""
    fold, steps = state_folders(spark, root, below)
    rows = spark.read.schema(STATE).parquet(fold).select("*", F.lit(-1).cast("bigint").alias("batch_id"))
    if steps:
        later = spark.read.schema(f"{STATE}, batch_id bigint").option("basePath", f"{root}/state").parquet(*steps)
        rows = rows.unionByName(later)
    last = F.max_by(F.struct("progress", "psum", "pn", "seen"), "batch_id").alias("s")
    return rows.groupBy("user_id").agg(last).select("user_id", "s.*")


def fold(spark: SparkSession, root: str, batch_id: int) -> None:
    """One row per user as of a committed batch; the pointer moves, then what two folds have replaced goes."""
    named = folds(spark, root)
    before = max(n for n in named if n < batch_id)
    read_state(spark, root, batch_id + 1).write.mode("overwrite").parquet(f"{root}/folded/upto={batch_id}")
    # nothing is dropped before the pointer is published, and nothing that it names
    commits.put(spark, f"{root}/folded/current", f"{before} {batch_id}")
    for n in named:
        if n < before:
            commits.remove(spark, f"{root}/folded/upto={n}")
    for name in commits.names(spark, f"{root}/state"):
        if int(name.removeprefix("batch_id=")) <= before:
            commits.remove(spark, f"{root}/state/{name}")
    commits.settle(spark, root, before)


def read_output(spark: SparkSession, root: str, name: str) -> DataFrame:
    """``states``, ``scores``, ``published`` or ``progress`` of committed batches."""
    return commits.read_committed(spark, root, name)


def advance(events: DataFrame, state: DataFrame, P: C.ProgressParams = C.ProgressParams()) -> DataFrame:
    """progress_states of a batch of (user_id, event_id, ts_ns, score) moving events from the given state."""
    users = events.select("user_id").distinct()
    mine = state.join(users, "user_id", "left_semi")
    start = mine.select("user_id", F.col("progress").alias("walking_progress"))
    prior = mine.select("user_id", F.col("psum").alias("_psum"), F.col("pn").alias("_pn"))
    seen = mine.select(F.col("user_id").alias("_user"), "seen")
    rows = prog.progress_states(events, start, None, P, prior=prior)
    rows = rows.join(seen, F.col("user_id") == F.col("_user"), "left")
    return rows.select("user_id", "event_id", "ts_ns", (F.col("k") + F.coalesce("seen", F.lit(0))).alias("k"), "score",
                       "progress", "saved", "published", "published_value")


def next_state(states: DataFrame, state: DataFrame) -> DataFrame:
    """The state rows of the users of a batch after it."""
    after = states.groupBy("user_id").agg(
        F.max_by("progress", "k").cast("bigint").alias("_p"), F.max("k").alias("_k"),
        F.sum(F.when(F.col("saved"), F.col("score"))).alias("_s"), F.count(F.when(F.col("saved"), 1)).alias("_n"))
    before = state.withColumnRenamed("user_id", "_user")
    return after.join(before, F.col("user_id") == F.col("_user"), "left").select(
        "user_id", F.col("_p").alias("progress"),
        (F.coalesce("psum", F.lit(0.0)) + F.coalesce("_s", F.lit(0.0))).alias("psum"),
        (F.coalesce("pn", F.lit(0)) + F.col("_n")).alias("pn"), F.col("_k").alias("seen"))


def step(events: DataFrame, batch_id: int, root: str, P: C.ProgressParams = C.ProgressParams(),
         compact_every: int = 50) -> None:
    """One micro-batch: states, stored scores, published rows, progress upserts and the next state version."""
    spark = events.sparkSession
    commits.withdraw(spark, root, batch_id)  # a repeated batch does not count until it is whole again
    state = read_state(spark, root, batch_id)
    part = f"batch_id={batch_id}"
    advance(events, state, P).write.mode("overwrite").parquet(f"{root}/states/{part}")
    states = spark.read.parquet(f"{root}/states/{part}")  # computed once for all sinks
    sinks.append_scores(prog.stored_scores(states), f"{root}/scores", batch_id)
    sinks.append_published(states, f"{root}/published", batch_id)
    sinks.upsert_progress(prog.progress_upserts(states, P=P), f"{root}/progress", batch_id)
    next_state(states, state).write.mode("overwrite").parquet(f"{root}/state/{part}")
    commits.commit(spark, root, batch_id)
    if (batch_id + 1) % compact_every == 0:
        fold(spark, root, batch_id)


def progress_writer(root: str, P: C.ProgressParams = C.ProgressParams(), compact_every: int = 50):
    """foreachBatch function for a stream of moving events."""

    def fn(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            step(batch.select("user_id", "event_id", "ts_ns", "score"), batch_id, root, P, compact_every)
        finally:
            batch.unpersist()

    return fn
