import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SMALL = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from tillstar.session import local_session

    session = local_session(4, app="tests", memory="6g")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def ctx(spark):
    from tillstar.catalog import Context

    return Context(spark, SMALL)


@pytest.fixture
def store(spark, ctx):
    from tillstar.sources.tables import TableStore

    return TableStore(spark, ctx.scratch("test"))


def rows(df, *columns):
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)
