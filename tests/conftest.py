import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF = {s: f"/root/testdata/sf{s}" for s in ["0.001", "0.01", "0.1"]}


@pytest.fixture(scope="session")
def spark():
    from meterflow.session import local_session

    session = local_session("*", app="meterflow-tests", extra={"spark.sql.shuffle.partitions": "8"})
    yield session
    session.stop()


@pytest.fixture
def scratch(tmp_path):
    return str(tmp_path)
