"""Session helpers.

The library never creates its own cluster configuration: it works with the
session it is handed.  ``local_session`` is only for tests and the bench.
"""

from __future__ import annotations

import os
import re
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "stride") -> SparkSession:
    """A local session for tests / bench (UI off, UTC, AQE on)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("STRIDE_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def _context(spark: SparkSession):
    """The SparkContext, or None where the session has none (Spark Connect)."""
    try:
        return spark.sparkContext
    except Exception:
        return None


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Read from the session (or a checkpoint dir already set on the context).
    Where nothing is set, a local master gets a folder of this machine (tests);
    any other master is refused: executors could not see the driver's disk.
    """
    sc = _context(spark)
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d and sc is not None:
        d = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not d:
        master = sc.master if sc is not None else ""
        if not re.match(r"local(\[|$)", master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        d = os.environ.get("STRIDE_CHECKPOINT_DIR", "/tmp/stride-checkpoints")
    return d.rstrip("/")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    root = checkpoint_root(spark)
    sc = _context(spark)
    if sc is not None and sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh directory below the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark)}/stride/{name}-{uuid.uuid4().hex[:12]}"


def materialize(df, name: str):
    """Write ``df`` once as parquet below the shared checkpoint folder and read it back.

    Cuts lineage like ``checkpoint()`` but computes the plan once (an eager
    RDD checkpoint computes it twice unless persisted) and keeps a columnar,
    pruned and pushed-down scan for the readers.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
