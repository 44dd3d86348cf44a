import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from seqtide import local_session  # noqa: E402
from seqtide.session import drop_intermediates  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("8", partitions=4)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    drop_intermediates(session)
    session.stop()
