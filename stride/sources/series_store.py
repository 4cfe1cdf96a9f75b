"""Labelled readings as a table bucketed by (keys, time bucket) and sorted by time.

The series scan shuffles readings by (key, time bucket) and sorts them by time.
A table written that way once serves every later scan without either: Spark
knows from the catalog that equal (key, bucket) lie in one file.  A key that
holds a third of all rows is still spread over all files by its time buckets.

The table is an external one, its files lie below the given folder; the
parameters it was written with are table properties, and a scan with other
buckets is refused.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .. import config as C
from ..operators.series import BUCKET, bucketed
from .tables import split_valid

TS = "ts_ns"
AXES = ("acc_x", "acc_y", "acc_z")
PROPERTY = "stride.bucket_ns"


def write(labelled: DataFrame, table: str, folder: str, params: C.MotionParams = C.MotionParams(), files: int = 64) -> None:
    """Write whole readings as the bucketed table ``table``: one sorted file for each of ``files`` hash buckets.

    Readings with a missing column are left out (``motion_plan`` reports them).
    """
    keys = list(params.keys)
    cols = [*keys, TS, *AXES]
    rows = bucketed(split_valid(labelled.select(*cols), cols)[0], TS, params.bucket)
    by = [*keys, BUCKET]
    # the writer deals rows by the same hash, so every task holds the rows of one file
    (rows.repartition(files, *by).write.mode("overwrite").format("parquet").bucketBy(files, *by).sortBy(*by, TS)
     .option("path", folder).saveAsTable(table))
    spark = labelled.sparkSession
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('{PROPERTY}' = '{params.bucket}')")


def read(spark: SparkSession, table: str, params: C.MotionParams = C.MotionParams()) -> DataFrame:
    """The stored readings with their time bucket; ``motion_plan`` takes them as they lie."""
    found = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}  # a few rows of metadata
    if found.get(PROPERTY) != str(params.bucket):
        raise ValueError(f"{table} has buckets of {found.get(PROPERTY)} ns, asked for {params.bucket}")
    return spark.table(table)
