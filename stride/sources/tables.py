"""Readers for the four stored tables and the request stream.

All readers are plain ``spark.read`` with an explicit schema; ``fmt`` and
``options`` pass through so that any Spark data source (parquet, a table
catalog, a connector jar on the cluster) can back them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

LABELLED_SCHEMA = T.StructType(
    [
        T.StructField("user_id", T.LongType()),
        T.StructField("activity", T.StringType()),
        T.StructField("ts_ns", T.LongType()),
        T.StructField("acc_x", T.DoubleType()),
        T.StructField("acc_y", T.DoubleType()),
        T.StructField("acc_z", T.DoubleType()),
    ]
)

LIVE_SCHEMA = T.StructType(
    [
        T.StructField("user_id", T.StringType()),
        T.StructField("timestamp", T.LongType()),
        T.StructField("timestamp_long", T.LongType()),
        T.StructField("x", T.DoubleType()),
        T.StructField("y", T.DoubleType()),
        T.StructField("z", T.DoubleType()),
    ]
)

PROGRESS_SCHEMA = T.StructType(
    [
        T.StructField("user_id", T.StringType()),
        T.StructField("walking_progress", T.IntegerType()),
        T.StructField("timestamp", T.LongType()),
    ]
)

SCORES_SCHEMA = T.StructType(
    [
        T.StructField("user_id", T.StringType()),
        T.StructField("timestamp", T.LongType()),
        T.StructField("perfect_number", T.DoubleType()),
    ]
)

REQUEST_SCHEMA = T.StructType(
    [
        T.StructField("request_id", T.LongType()),
        T.StructField("request_ts", T.LongType()),
        T.StructField("value", T.StringType()),
    ]
)

#: Nanoseconds per unit of a stored time.
TIME_UNITS = {"ns": 1, "us": 1_000, "ms": 1_000_000, "s": 1_000_000_000}


def _read(spark: SparkSession, path: str | None, schema: T.StructType, fmt: str, options: dict | None,
          columns: dict[str, str] | None = None) -> DataFrame:
    """``columns``: our column name -> the table's, for those that differ."""
    names = {f.name: (columns or {}).get(f.name, f.name) for f in schema.fields}
    r = spark.read.format(fmt).options(**(options or {}))
    if fmt not in ("parquet", "orc", "delta"):
        stored = {names[f.name]: f.dataType for f in schema.fields}  # two of our columns may be one of theirs
        r = r.schema(T.StructType([T.StructField(n, t) for n, t in stored.items()]))
    df = r.load(path) if path else r.load()
    return df.select(*[F.col(f"`{names[f.name]}`").cast(f.dataType).alias(f.name) for f in schema.fields])


def read_labelled(spark: SparkSession, path: str | None = None, fmt: str = "parquet", options: dict | None = None,
                  columns: dict[str, str] | None = None, time_unit: str = "ns") -> DataFrame:
    """Labelled accelerations: user_id, activity, ts_ns, acc_x, acc_y, acc_z.

    A table that names its time ``timestamp`` is read with
    ``columns={"ts_ns": "timestamp"}``; ``time_unit`` is what it counts.
    """
    df = _read(spark, path, LABELLED_SCHEMA, fmt, options, columns)
    return df.withColumn("ts_ns", F.col("ts_ns") * F.lit(TIME_UNITS[time_unit]))


def read_live(spark: SparkSession, path: str | None = None, fmt: str = "parquet", options: dict | None = None,
              columns: dict[str, str] | None = None, time_unit: str = "ns") -> DataFrame:
    """Live accelerations: user_id (uuid text), timestamp, timestamp_long, x, y, z.

    ``columns``: our name -> the table's, e.g. ``{"timestamp_long": "timestamp"}``
    for a table with one time column.  Both times count ``time_unit`` and become
    nanoseconds; a time beyond the long range becomes NULL, its reading is left out.
    """
    df = _read(spark, path, LIVE_SCHEMA, fmt, options, columns)
    unit = F.lit(TIME_UNITS[time_unit])
    return df.withColumns({c: F.try_multiply(F.col(c), unit) for c in ("timestamp", "timestamp_long")})


def read_progress(spark: SparkSession, path: str | None = None, fmt: str = "parquet", options: dict | None = None) -> DataFrame:
    return _read(spark, path, PROGRESS_SCHEMA, fmt, options)


def read_scores(spark: SparkSession, path: str | None = None, fmt: str = "parquet", options: dict | None = None) -> DataFrame:
    return _read(spark, path, SCORES_SCHEMA, fmt, options)


def bus_messages(records: DataFrame) -> DataFrame:
    """Records of a message bus (binary value, partition, offset, timestamp) -> request_id, request_ts, value.

    The identifier orders the records of a partition and keeps partitions
    apart, so records read by many consumers in parallel need no coordination.
    """
    return records.select(
        (F.col("partition").cast("bigint") * F.lit(1 << 40) + F.col("offset")).alias("request_id"),
        (F.unix_micros(F.col("timestamp")) * 1000).alias("request_ts"),
        # bad bytes are kept as they are: the parser sends them to the dead letters
        F.col("value").cast("string").alias("value"),
    )


def read_requests_stream(spark: SparkSession, path: str | None = None, fmt: str = "parquet",
                         options: dict | None = None, schema: T.StructType = REQUEST_SCHEMA) -> DataFrame:
    """Request messages as a stream.

    For a message bus pass e.g. ``fmt="kafka"`` with its options (the
    connector jar must be on the cluster); ``value`` is read as UTF-8 and
    the bus offset becomes ``request_id``.
    """
    r = spark.readStream.format(fmt).options(**(options or {}))
    if fmt == "kafka":
        return bus_messages(r.load())
    r = r.schema(schema)
    return r.load(path) if path else r.load()


def _complete(required: list[str]):
    ok = F.lit(True)
    for c in required:
        ok = ok & F.col(c).isNotNull()
    return ok


def read_counts(required: list[str]) -> list:
    """``n_read`` and ``n_rejected`` for ``DataFrame.observe``: counted in the pass that reads the rows anyway."""
    return [F.count(F.lit(1)).alias("n_read"), F.count_if(~_complete(required)).alias("n_rejected")]


def split_valid(df: DataFrame, required: list[str]) -> tuple[DataFrame, DataFrame]:
    """Rows with every required column present, and the rejected rest (side output)."""
    ok = _complete(required)
    return df.filter(ok), df.filter(~ok)
