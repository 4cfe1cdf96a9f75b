"""Regression guards on the physical plan (auto-broadcast off, as at scale).

The feature plan must read its input twice at most (a narrow shuffle for the
interval scan, a wide one for the range join) and reuse those exchanges for
every other consumer; the progress plan must not re-shuffle events by user.
"""

import re

from stride.plans import registry as R
from tests.conftest import SF_SMALL


def _final_plan(spark, df) -> str:
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.debug.maxToStringFields", "1000")
    try:
        df.collect()
        return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_feature_plan_shares_input_shuffles(spark):
    plan = _final_plan(spark, R.q_features(spark, SF_SMALL))
    assert len(re.findall(r"FileScan parquet", plan)) == 2
    assert len(re.findall(r"ReusedExchange", plan)) >= 3


def test_progress_plan_keeps_events_bucketed(spark):
    plan = _final_plan(spark, R.q_progress_states(spark, SF_SMALL))
    # every exchange directly above the full event scan is keyed by (user, bucket)
    lines = plan.splitlines()
    found = 0
    for i, line in enumerate(lines):
        if "FileScan parquet [event_id,ts,user_id,event_type,value,props]" in re.sub(r"#\d+L?", "", line):
            above = [x for x in lines[max(0, i - 12):i] if "Exchange hashpartitioning" in x and "Reused" not in x]
            assert above and "_bucket" in above[-1]
            found += 1
    assert found >= 1


def test_start_anchored_windows_need_no_range_join(spark):
    """One scan of the readings; the carries are joined on (key, bucket) and (key, super-bucket), equalities only."""
    plan = _final_plan(spark, R.q_features_start(spark, SF_SMALL))
    plain = re.sub(r"#\d+L?", "", plan)
    assert len(re.findall(r"Generate", plain)) == 0 and "NestedLoop" not in plain
    joins = [line for line in plain.splitlines() if "SortMergeJoin" in line]
    assert joins and all("_bucket" in j or "_super" in j for j in joins) and not any("window_lo" in j for j in joins)
    assert len(re.findall(r"FileScan parquet", plain)) <= 2


def test_stored_series_are_scanned_without_a_shuffle(spark):
    """The window over the readings lies on the scan itself; only summaries, one row per (key, bucket), are exchanged."""
    plan = re.sub(r"#\d+L?", "", _final_plan(spark, R.q_intervals_stored(spark, SF_SMALL)))
    lines = plan.splitlines()
    scans = [i for i, line in enumerate(lines) if "FileScan parquet" in line]
    depth = lambda line: len(line) - len(line.lstrip(" :+-*"))
    for i in scans:
        assert "SelectedBucketsCount: 8 out of 8" in lines[i]
        # from the scan upwards: the window comes before any exchange
        above, level = [], depth(lines[i])
        for line in reversed(lines[:i]):
            if depth(line) < level:
                level = depth(line)
                above.append(line)
        names = [n for n in above if "Window [" in n or "Exchange hash" in n]
        assert names and "Window [" in names[0]
