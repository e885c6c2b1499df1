from __future__ import annotations

import os

import pytest

from tillwork.session import local_session

SF = os.environ.get("TILLWORK_SF", "0.001")


@pytest.fixture(scope="session")
def spark():
    session = local_session("tillwork-tests", cores=os.environ.get("TILLWORK_CORES", "8"), shuffle_partitions=4)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def folder():
    return f"/root/testdata/sf{SF}"


@pytest.fixture(scope="session")
def duck(folder):
    from tests.compare import connect

    return connect(folder)


@pytest.fixture
def rows(spark):
    """rows("a int, b string", (1, "x"), ...) -> DataFrame"""
    return lambda schema, *data: spark.createDataFrame(list(data), schema)
