import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
os.environ["PYTHONPATH"] = f"{Path(__file__).resolve().parent.parent}:{os.environ.get('PYTHONPATH', '')}"
DATA = os.environ.get("AGROLITH_TESTDATA", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from agrolith.session import local_session

    s = local_session("4", **{"spark.sql.shuffle.partitions": "4"})
    yield s
    s.stop()


@pytest.fixture(scope="session")
def data():
    if not os.path.isdir(DATA):
        pytest.skip("no test tables")
    return DATA

