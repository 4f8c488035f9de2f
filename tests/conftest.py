import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from concord.session import get_spark
    s = get_spark("local[*]", shuffle_partitions=8, app_name="concord-tests")
    yield s


@pytest.fixture(scope="session")
def duck():
    from check_oracles import duck as make
    return make(SMALL)
