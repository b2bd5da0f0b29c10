import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from lakerisk.session import build_session  # noqa: E402

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    conf = {"spark.sql.shuffle.partitions": "4", "spark.checkpoint.dir": str(tmp_path_factory.mktemp("scratch"))}
    session = build_session("local[8]", **conf)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def data():
    return DATA
