from __future__ import annotations

import os
import sys
import tempfile

import pytest
from pyspark import cloudpickle

sys.path[:0] = [os.path.dirname(os.path.dirname(os.path.abspath(__file__))), os.path.dirname(os.path.abspath(__file__))]

import fixtures  # noqa: E402

cloudpickle.register_pickle_by_value(fixtures)

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from corpusmill.session import build_session

    session = build_session(
        app="corpusmill-tests",
        master="local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "4g",
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="run-", dir="/tmp"),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture()
def workdir():
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")
