"""Every query with SQL against DuckDB on the smallest tables."""

import pytest

from quillgraph.plans.queries import ORACLES, QUERIES
from tests.compare import duck, same

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    df = QUERIES[name](spark, SF)
    if name in ORACLES:
        same(df, duck(SF), ORACLES[name])
    else:
        assert df.count() > 0


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
