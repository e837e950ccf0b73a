"""Every registered query of the evidence engine against its SQL, on the smallest tables."""

import pytest

from helixlake.plans import registry
from tests.compare import rows


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_query_matches_sql(name, spark, duck, sf_dir):
    got = registry.QUERIES[name](spark, sf_dir).toPandas()
    want = duck.sql(registry.ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.ORACLES)))
def test_query_runs(name, spark, sf_dir):
    assert registry.QUERIES[name](spark, sf_dir).count() > 0


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).limit(1).count() == 1
    assert set(entry.oracle_sql()) <= set(entry.queries())
