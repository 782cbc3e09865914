"""Every registered query against its SQL, on the smallest tables."""

import pytest

import __spark_entry__ as entry
from compare import connect, differences

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, con, name):
    df = entry.queries()[name](spark, FOLDER)
    if name in entry.oracle_sql():
        assert differences(df, con, entry.oracle_sql()[name]) == []
    else:
        assert df.count() > 0


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() == 5
