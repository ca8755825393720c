import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from loanloom.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    warehouse = {"spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse"))}
    session = build_session("tests", "local[8]", 8, warehouse)
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()
