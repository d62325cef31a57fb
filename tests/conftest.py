import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from ledgerly.session import get_session, let_workers_import
    s = get_session(master="local[*]", shuffle_partitions=8)
    let_workers_import(s)
    yield s
