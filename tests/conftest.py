import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from netpulse.session import build_session  # noqa: E402

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    base = tmp_path_factory.mktemp("spark")
    extra = {
        "spark.sql.shuffle.partitions": "4", "spark.driver.memory": "4g",
        "spark.sql.warehouse.dir": str(base / "warehouse"), "spark.ui.showConsoleProgress": "false",
        "spark.checkpoint.dir": str(base / "staging"),
    }
    session = build_session("netpulse-tests", "local[4]", **extra)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR
