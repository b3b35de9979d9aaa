import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from oracle_check import session

    from warcloom.session import configure

    found = session()
    found.sparkContext.setLogLevel("ERROR")
    return configure(found)
