"""Every query of this part against its SQL oracle, and the comparer against wrong answers."""

import pytest

import __spark_entry__ as entry
from checks.compare import connect, difference
from checks.oracles import all_oracles
from checks.queries import all_queries

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_query_equals_its_oracle(spark, connection, name):
    assert difference(entry.queries()[name](spark, SF_DIR), connection, entry.oracle_sql()[name]) is None


def test_every_query_has_an_oracle():
    assert set(all_queries()) == set(all_oracles())
    assert set(all_queries()) <= set(entry.queries()) and set(all_oracles()) <= set(entry.oracle_sql())


def test_entry(spark):
    frame = entry.entry(spark)
    assert len(frame.columns) == 48 and frame.count() > 0


@pytest.mark.parametrize(
    "sql, complaint",
    [
        ("SELECT 1 AS other", "columns differ"),
        ("SELECT 'x' AS id", "types differ"),
        ("SELECT CAST(1 AS BIGINT) AS id", "unexpected"),
        ("SELECT CAST(0 AS BIGINT) AS id UNION ALL SELECT 0", "lacking"),
    ],
)
def test_the_comparer_notices(spark, connection, sql, complaint):
    assert complaint in difference(spark.range(1), connection, sql)
