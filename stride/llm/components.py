"""Connected components of an edge table by alternating large-star and small-star steps.

Every step is a pre-aggregated minimum per node and a join of two edge-sized
tables (a node with a third of all edges is split by the skew join); each step
is written to the shared checkpoint folder, so nothing is collected and no
lineage grows.  The number of steps is logarithmic in the longest chain.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stride.llm.common import cut


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """edges (u, v) -> edges to the smallest neighbour (large: of every node; small: among smaller neighbours)."""
    if large:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        both = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("_u"), F.least("_u", "m").alias("m"))
    joined = both.join(least, F.col("u") == F.col("_u"))
    if large:
        moved = joined.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        moved = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select(F.col("_u").alias("u"), F.col("m").alias("v")))
    return moved.where(F.col("u") != F.col("v")).distinct()


def components(edges: DataFrame, u: str, v: str) -> DataFrame:
    """(node, root): root is the smallest node of the component; nodes without an edge are absent.

    Self-links and nulls are dropped, repeated links count once, no edges give no rows.
    """
    rows = edges.select(F.col(u).alias("u"), F.col(v).alias("v")).where(
        F.col("u").isNotNull() & F.col("v").isNotNull() & (F.col("u") != F.col("v"))).distinct()
    rows = cut(rows, "edges")
    # order-free digest of the edge set: one row for the driver
    state = [F.count(F.lit(1)), F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.lit(0))]
    before = None
    while True:
        rows = cut(_star(_star(rows, True), False), "edges")
        after = rows.agg(*state).first()
        if after == before or after[0] == 0:
            break
        before = after
    return rows.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        rows.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
