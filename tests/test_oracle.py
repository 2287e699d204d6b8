"""Every registered query against its SQL on DuckDB: names, types and all values."""

from __future__ import annotations

import pytest
from compare import connect, differences
from conftest import TESTDATA

from footfall.plans.oracles import ORACLES
from footfall.plans.registry import QUERIES


@pytest.fixture(scope="module")
def duck():
    with connect(TESTDATA) as con:
        yield con


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, duck, name):
    assert differences(QUERIES[name](spark, TESTDATA), duck, ORACLES[name]) == []
