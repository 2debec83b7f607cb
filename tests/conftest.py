from __future__ import annotations

import os

import pytest

from allocspark.session import build_session
from tests.oracle import connect

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = tmp_path_factory.mktemp("checkpoints")
    session = build_session("tests", 8, **{
        "spark.sql.shuffle.partitions": "4", "spark.checkpoint.dir": str(folder),
        "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g",
    })
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture(scope="session")
def sql(sf_dir):
    return connect(sf_dir)
