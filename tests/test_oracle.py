"""Every query with SQL beside it must give the same rows in DuckDB; the others must give rows."""

import pytest

from oracle import connect, difference
from tidemill.registry import all_queries

MIDDLE = "/root/testdata/sf0.01"
SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    return connect(MIDDLE)


@pytest.mark.parametrize("name", sorted(n for n, q in all_queries().items() if q.oracle))
def test_same_rows_as_sql(spark, db, name):
    assert difference(spark, db, all_queries()[name], MIDDLE) is None


@pytest.mark.parametrize("name", sorted(n for n, q in all_queries().items() if not q.oracle))
def test_gives_rows(spark, name):
    assert all_queries()[name](spark, SMALL).count() > 0


def test_entry(spark):
    import __spark_entry__ as entry

    df = entry.entry(spark)
    assert df.columns == ["user_id", "cnt_days"] and df.count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
