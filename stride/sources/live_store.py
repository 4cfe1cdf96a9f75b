"""The live table as a store laid out for range requests.

Readings are written in folders ``batch_id / _day / _slot``: the day of the
reading and a hash of its user.  Beside them a zone map keeps, per user and
day, the first and last reading and their number, in the same batches.

A request asks for users and times.  Its (day, slot) pairs, of which there are
at most days times slots whatever the requests' number, are joined to the
readings on the folder columns, so Spark prunes folders when the query runs
(dynamic partition pruning): unasked days and users are not opened.  The span
a request is cut to comes from the zone map, not from a scan of the readings.

A retried batch replaces its own folders; readers see whole batches only
(each is committed by a file of its own, written last).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalar import floor_div, is_uuid
from ..operators.requests import canonical_uuid
from ..session import materialize
from . import commits
from .tables import LIVE_SCHEMA

DAY, SLOT = "_day", "_slot"
DAY_NS = 24 * 3_600_000_000_000
ZONES = "user_id string, _day bigint, first_ts bigint, last_ts bigint, n_rows bigint"


@dataclass(frozen=True)
class Layout:
    """``slots``: hash slots of users; at most days x slots pairs are broadcast to prune folders."""

    slots: int = 64
    day_ns: int = DAY_NS


def _slot(user: Column, layout: Layout) -> Column:
    return F.pmod(F.hash(user), F.lit(layout.slots))


def append(live: DataFrame, root: str, batch_id: int, layout: Layout = Layout()) -> None:
    """Write one batch of live readings (``read_live``'s columns) and its zones, then commit it.

    Users are stored in canonical form; readings without an identifier, time or
    axis can answer no request and are left out.
    """
    spark = live.sparkSession
    whole = F.lit(True)
    for c in ("timestamp", "x", "y", "z"):
        whole = whole & F.col(c).isNotNull()
    rows = live.filter(is_uuid(F.col("user_id")) & whole).select(
        canonical_uuid(F.col("user_id")).alias("user_id"), *[c for c in LIVE_SCHEMA.names if c != "user_id"])
    rows = rows.select("*", floor_div("timestamp", layout.day_ns).alias(DAY), _slot(F.col("user_id"), layout).alias(SLOT))
    target = f"{root}/readings/batch_id={batch_id}"
    # rebalanced: few files per folder, and a folder that holds most rows is written by many tasks
    rows.hint("rebalance", DAY, SLOT).sortWithinPartitions(DAY, SLOT, "user_id", "timestamp").write.partitionBy(DAY, SLOT).mode("overwrite").parquet(target)
    written = spark.read.schema(rows.schema).parquet(target)
    written.groupBy("user_id", DAY).agg(
        F.min("timestamp").alias("first_ts"), F.max("timestamp").alias("last_ts"), F.count(F.lit(1)).alias("n_rows")).write.mode(
        "overwrite").parquet(f"{root}/zones/batch_id={batch_id}")
    commits.commit(spark, root, batch_id)


def _committed(spark: SparkSession, root: str, name: str, schema: str) -> DataFrame:
    """Committed batches' rows, without the batch; no rows before the first batch."""
    if not commits.names(spark, f"{root}/{name}"):
        return spark.createDataFrame([], schema)
    upto, single = commits.settled(spark, root), commits.committed(spark, root)
    whole = F.col("batch_id").isin(single) if single else F.lit(False)
    if upto is not None:
        whole = whole | (F.col("batch_id") <= upto)
    return spark.read.schema(f"{schema}, batch_id bigint").parquet(f"{root}/{name}").filter(whole).drop("batch_id")


def readings(spark: SparkSession, root: str) -> DataFrame:
    """All committed readings with their folder columns."""
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in LIVE_SCHEMA.fields)
    return _committed(spark, root, "readings", f"{schema}, {DAY} bigint, {SLOT} int")


def zones(spark: SparkSession, root: str) -> DataFrame:
    """(user_id, day, first_ts, last_ts, n_rows): one row per user and day."""
    rows = _committed(spark, root, "zones", ZONES)
    return rows.groupBy("user_id", DAY).agg(F.min("first_ts").alias("first_ts"), F.max("last_ts").alias("last_ts"), F.sum("n_rows").alias("n_rows"))


def live_spans(zone_rows: DataFrame) -> DataFrame:
    """First and last reading time and number per user, from the zone map (``requests.live_spans`` scans the readings)."""
    return zone_rows.groupBy(F.col("user_id").alias("_live_user")).agg(
        F.min("first_ts").alias("_first"), F.max("last_ts").alias("_last"), F.sum("n_rows").alias("_n"))


def asked_folders(spans: DataFrame, zone_rows: DataFrame, layout: Layout = Layout()) -> DataFrame:
    """Distinct (day, slot) that hold a reading some span (user_id, _from, _to) may cover."""
    zone = zone_rows.select(F.col("user_id").alias("_u"), DAY, "first_ts", "last_ts")
    # spans of a user that overlap count once: the user's days are marked, not the pairs
    meets = (F.col("user_id") == F.col("_u")) & (F.col("_from") <= F.col("last_ts")) & (F.col("_to") >= F.col("first_ts"))
    hit = zone.join(spans.select("user_id", "_from", "_to").distinct(), meets, "left_semi")
    return hit.select(F.col(DAY).alias("_asked_day"), _slot(F.col("_u"), layout).alias("_asked_slot")).distinct()


def asked_readings(spark: SparkSession, root: str, spans: DataFrame, layout: Layout = Layout()) -> DataFrame:
    """The readings of the folders that the spans touch; other folders are not opened.

    The pairs are written first: Spark prunes by a join's small side where that
    is a plain filtered scan.  Their first and last day prune when planning.
    """
    asked = materialize(asked_folders(spans, zones(spark, root), layout), "asked-folders")
    first, last = asked.agg(F.min("_asked_day"), F.max("_asked_day")).first()
    rows = readings(spark, root)
    if first is None:
        return rows.limit(0).select(*LIVE_SCHEMA.names)
    days = asked.where(F.col("_asked_day").between(first, last))  # days x slots rows at most
    both = (F.col(DAY) == F.col("_asked_day")) & (F.col(SLOT) == F.col("_asked_slot"))
    return rows.where(F.col(DAY).between(first, last)).join(F.broadcast(days), both).select(*LIVE_SCHEMA.names)


@dataclass(frozen=True)
class LiveStore:
    """A stored live table as ``requests.request_features`` takes it in place of a DataFrame."""

    spark: SparkSession
    root: str
    layout: Layout = Layout()

    def spans(self) -> DataFrame:
        return live_spans(zones(self.spark, self.root))

    def readings(self, spans: DataFrame) -> DataFrame:
        return asked_readings(self.spark, self.root, spans, self.layout)
