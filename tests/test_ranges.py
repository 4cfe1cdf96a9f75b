"""Bucketed range join vs a brute-force range join (property test)."""

import numpy as np
import pandas as pd
import pytest

from stride.operators import ranges, series


def _brute(spans: pd.DataFrame, rd: pd.DataFrame, closed: bool) -> list[tuple]:
    m = spans.merge(rd, on="k")
    inside = (m.ts >= m.lo) & (m.ts <= m.hi) if closed else (m.ts > m.lo) & (m.ts < m.hi)
    return sorted(map(tuple, m[inside][["sid", "ts"]].itertuples(index=False, name=None)))


@pytest.mark.parametrize("closed", [True, False])
@pytest.mark.parametrize("bucket", [1, 7, 100])
def test_range_members_equals_brute_force(spark, closed, bucket):
    rng = np.random.default_rng(bucket + (1 if closed else 0))
    rd = pd.DataFrame({"k": rng.choice(["a", "b", "c"], 3000), "ts": rng.integers(0, 20_000, 3000)})
    lo = rng.integers(-50, 20_000, 300)
    length = rng.choice([0, 1, 5, 50, 500, 9000], 300)  # 9000 buckets > CHUNK at bucket 1
    spans = pd.DataFrame({"sid": np.arange(300), "k": rng.choice(["a", "b", "c", "z"], 300), "lo": lo,
                          "hi": lo + length})
    spans.loc[::17, "hi"] = spans.loc[::17, "lo"] - 3  # reversed spans match nothing
    sdf = spark.createDataFrame(spans)
    rdf = series.local_order(spark.createDataFrame(rd), ["k"], "ts", bucket, 0)
    rdf = rdf.select("k", series.BUCKET, "ts")
    got = ranges.range_members(sdf, rdf, ["k"], "ts", "lo", "hi", closed, bucket).select("sid", "ts").collect()
    assert sorted((r.sid, r.ts) for r in got) == _brute(spans, rd, closed)


def test_explode_range_chunks_and_empty(spark):
    df = spark.createDataFrame([(1, 0, 10_000), (2, 5, 5), (3, 9, 2)], "id long, lo long, hi long")
    from pyspark.sql import functions as F

    out = ranges.explode_range(df, F.col("lo"), F.col("hi"), "v", chunk=1000).groupBy("id").agg(
        F.count("v").alias("n"), F.min("v").alias("a"), F.max("v").alias("b")).collect()
    got = {r.id: (r.n, r.a, r.b) for r in out}
    assert got == {1: (10_001, 0, 10_000), 2: (1, 5, 5)}
