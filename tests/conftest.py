import os
import pathlib
import sys

import pytest

ROOT = pathlib.Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from shelfrank import build_session

    session = build_session(
        "shelfrank-tests",
        master="local[4]",
        spark_sql_shuffle_partitions="4",
        spark_ui_enabled="false",
        spark_ui_showConsoleProgress="false",
        spark_driver_memory="4g",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    if not os.path.isdir(SF_DIR):
        pytest.skip("no test tables")
    return SF_DIR
