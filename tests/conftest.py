import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from quire.runtime import session, ship

    s = session("tests", cpus="4", **{"spark.driver.memory": "4g"})
    ship(s)
    yield s
    s.stop()
