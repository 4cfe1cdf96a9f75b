"""Commit records and pointers: which batches of a folder tree are whole, and which version is current.

A batch writes several folders ``<name>/batch_id=N``; the last thing it does is
to write ``commits/N``, a file made under another name and renamed.  A reader
that goes by the records never sees some outputs of a batch without the others,
and opens folders by name instead of listing them all.  Batches are committed
in order, so ``settle`` replaces the records up to a batch by one number.

Works with any file system that Spark's Hadoop client reaches.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names inside a folder; none where it does not exist."""
    fs, p = _fs(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def put(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file in one step: readers see all of it or the former one."""
    fs, p = _fs(spark, path)
    fs.mkdirs(p.getParent())
    part = _path(spark, f"{path}._part")
    out = fs.create(part, True)
    out.write(bytearray(text.encode()))
    out.close()
    if fs.exists(p):
        fs.delete(p, False)
    if not fs.rename(part, p):
        raise OSError(f"cannot publish {path}")


def get(spark: SparkSession, path: str) -> str | None:
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return None
    size = fs.getFileStatus(p).getLen()
    stream = fs.open(p)
    try:
        return bytes(stream.readNBytes(size)).decode()
    finally:
        stream.close()


def remove(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    if fs.exists(p):
        fs.delete(p, True)


def commit(spark: SparkSession, root: str, batch_id: int) -> None:
    put(spark, f"{root}/commits/{batch_id}", "")


def withdraw(spark: SparkSession, root: str, batch_id: int) -> None:
    remove(spark, f"{root}/commits/{batch_id}")


def settled(spark: SparkSession, root: str) -> int | None:
    """The batch up to which all are committed and their single records gone."""
    text = get(spark, f"{root}/commits/settled")
    return int(text) if text else None


def settle(spark: SparkSession, root: str, upto: int) -> None:
    """One number instead of the records up to a batch (all of them committed)."""
    put(spark, f"{root}/commits/settled", str(upto))
    for n in names(spark, f"{root}/commits"):
        if n.isdigit() and int(n) <= upto:
            remove(spark, f"{root}/commits/{n}")


def committed(spark: SparkSession, root: str) -> list[int]:
    """Committed batches that have a record of their own, ascending."""
    return sorted(int(n) for n in names(spark, f"{root}/commits") if n.isdigit())


def is_committed(spark: SparkSession, root: str, batch_id: int) -> bool:
    upto = settled(spark, root)
    return (upto is not None and batch_id <= upto) or str(batch_id) in names(spark, f"{root}/commits")


def read_committed(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The rows of ``<name>/batch_id=N`` of committed batches only."""
    upto, single = settled(spark, root), committed(spark, root)
    whole = F.col("batch_id").isin(single) if single else F.lit(False)
    if upto is not None:
        whole = whole | (F.col("batch_id") <= upto)
    return spark.read.parquet(f"{root}/{name}").filter(whole)
