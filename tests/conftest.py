import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

DATA = "/root/testdata"


@pytest.fixture(scope="session")
def spark():
    from quirewright.session import local_session

    s = local_session(cores=4)
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
