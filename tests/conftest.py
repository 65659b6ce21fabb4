import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from genoframe.session import get_session
    s = get_session("local[4]", shuffle_partitions=4)
    yield s


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture(scope="session")
def con(sf):
    from genoframe.plans.verify import duck
    return duck(sf)
