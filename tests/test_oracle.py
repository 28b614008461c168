"""Every catalogued query against its SQL on DuckDB."""

import pytest

import check
from tests.conftest import SMALL
from tillstar.catalog import ORACLES, QUERIES, oracle_text


@pytest.fixture(scope="module")
def con():
    return check.duck(SMALL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_agrees(spark, con, name):
    df = QUERIES[name](spark, SMALL)
    problem, _ = check.compare(df, con, oracle_text(ORACLES[name]))
    assert problem is None, problem


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
