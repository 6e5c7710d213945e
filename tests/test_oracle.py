"""Every registered query against its SQL twin in DuckDB."""

import __spark_entry__ as entry
import pytest
from compare import connect, differences
from workload.oracle import ORACLE
from workload.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


def test_every_query_has_its_twin():
    assert QUERIES.keys() == ORACLE.keys()
    assert QUERIES.keys() <= entry.queries().keys()
    assert ORACLE.keys() <= entry.oracle_sql().keys()


@pytest.mark.parametrize("name", QUERIES)
def test_same_rows(spark, duck, name):
    assert differences(QUERIES[name](spark, SF), duck, ORACLE[name]) == []


def test_entry(spark):
    df = entry.entry(spark)
    assert len(df.columns) == 665 + 3
    assert df.count() > 0
