"""Registered queries against their SQL, and what the entry point lists."""

import __spark_entry__ as entry
import pytest
from compare import connect, differences

from billbook.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", ORACLE)
def test_same_rows(spark, duck, name):
    assert differences(QUERIES[name](spark, SF), duck, ORACLE[name]) == []


def test_all_thirteen_and_the_pipeline_are_registered():
    names = entry.queries()
    assert all(sum(n.startswith(f"op{i}_") for n in names) == 1 for i in range(1, 14))
    assert "pipeline" in names and ORACLE.items() <= entry.oracle_sql().items()
