"""Driver contract: entry smoke, registry / oracle keys, fixture counts."""

import __spark_entry__ as E
from tests.conftest import SF_SMALL


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() == 192  # non-empty end-anchored windows at sf0.001


def test_oracle_keys_subset_of_queries():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert len(o) >= 27


def test_fixture_counts(spark):
    from stride.plans import registry as R

    assert R.q_intervals(spark, SF_SMALL).count() == 75
    assert R.q_windows_end(spark, SF_SMALL).count() == 406
