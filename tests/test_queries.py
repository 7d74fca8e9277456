"""Every registered query beside its SQL, on whole tables."""

import pytest

import __spark_entry__ as entry
from compare import connect, spark_rows, sql_rows
from seriesmart import checks

QUERIES, SQL = checks.all_queries(), checks.all_sql()


@pytest.fixture(scope="module")
def database(folder):
    return connect(folder)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_its_sql(spark, folder, database, name):
    assert name in SQL
    got, want = spark_rows(QUERIES[name](spark, folder)), sql_rows(database, SQL[name])
    assert got[0] == want[0]
    assert len(got[1]) == len(want[1])
    assert got[1] == want[1]


def test_the_flagship_has_rows_and_a_stable_schema(spark):
    first, second = entry.entry(spark), entry.entry(spark)
    assert first.schema == second.schema and first.count() == 10
