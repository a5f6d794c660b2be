"""Every registered query with SQL, against DuckDB on the smallest tables."""

import pytest

import check
from __spark_entry__ import entry, oracle_sql, queries

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return check.connect(FOLDER)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_matches_sql(spark, con, name):
    ok, note = check.compare(spark, con, FOLDER, name, queries()[name], oracle_sql()[name])
    assert ok, note


def test_entry(spark):
    df = entry(spark)
    assert set(df.columns) == {"adversarial", "harm", "n", "n_words", "accuracy"}
    assert df.count() > 0
