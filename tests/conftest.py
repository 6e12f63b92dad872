import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from tallymill.session import build_session

    session = build_session("tests", master="local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.maxMetadataStringLength": "4000"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.01"
