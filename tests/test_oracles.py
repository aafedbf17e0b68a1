"""Every query with SQL gives the same rows as that SQL."""

import pytest
from helpers import SMALL, oracle, rows

from inkwright.plans import registry


@pytest.mark.parametrize("name", sorted(registry.oracles()))
def test_query_matches_sql(spark, name):
    found, wanted = rows(registry.queries()[name](spark, SMALL)), oracle(registry.oracles()[name])
    assert len(found) == len(wanted)
    assert found == wanted


@pytest.mark.parametrize("name", sorted(set(registry.queries()) - set(registry.oracles())))
def test_query_without_sql_runs(spark, name):
    df = registry.queries()[name](spark, SMALL)
    assert df.columns and df.count() >= 0


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
