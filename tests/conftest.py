import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from threadloom import session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = session.build(cores=4, partitions=4)
    s.sparkContext.setLogLevel("ERROR")
    return s
