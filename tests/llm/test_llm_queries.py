"""The queries against their SQL, over whole small tables."""

from __future__ import annotations

import pytest
from compare import connect, differences
from conftest import TESTDATA

from footfall.llm.oracles import ORACLES
from footfall.llm.queries import QUERIES


def test_queries_are_all_there():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    with connect(TESTDATA) as duck:
        assert differences(QUERIES[name](spark, TESTDATA), duck, ORACLES[name]) == []
