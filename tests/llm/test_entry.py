"""The queries of this part: registered, whole, and equal to their SQL where there is some."""

import pytest

import __spark_entry__ as entry
import check
from tickweave.llm import queries

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_its_sql(spark, name):
    ok, note = check.compare(spark, check.connect(SMALL), SMALL, name, queries.QUERIES[name], queries.ORACLES[name])
    assert ok, note


def test_one_query_per_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))
    assert set(queries.QUERIES) | {"pipeline"} <= set(entry.queries())
